"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

The classifier is fitted on a bounded sample of labelled texts (``MAX_EXAMPLES``): the
terms, whole words and word beginnings, whose presence tells the classes apart by
the G statistic become the space; the sample's texts become vectors in it. Document
frequencies of these terms are counted over all documents.

The examples are indexed by term: postings in blocks of ``BLOCK`` examples with the
greatest weight of each block. A text is scored exactly: blocks are visited by falling
bound (the query's weights times the blocks' maxima) until no block can beat the k-th
best cosine. The k nearest vote with their cosine; the score is shrunk toward the
share of toxic examples, and the neighbours are the evidence.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corvane.llm.common import Memo, map_rows

MAX_EXAMPLES = 12_000
MAX_TERMS = 512
LEAST_G = 20.0
NEIGHBOURS = 15
BLOCK = 64
THRESHOLD = 0.3
SHRINK = 0.5
PREFIXES = (4, 5, 6)
WORD = re.compile(r"\w+")


def terms_of(word: str) -> list[str]:
    """A word and its beginnings; beginnings end in ``*`` to keep them apart."""
    return [word, *(word[:n] + "*" for n in PREFIXES if len(word) > n)]


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


@dataclass
class Model:
    """The space (term -> place, idf) and the indexed examples."""

    terms: dict[str, int]
    idf: np.ndarray
    ids: np.ndarray        # example ids in index order
    toxic: np.ndarray
    weights: np.ndarray    # examples x terms, unit length; bounded by the sample and MAX_TERMS
    block_max: np.ndarray  # terms x blocks
    prior: float
    empty: float           # score of a text without any term of the space


def _vector(counts: dict[int, int], idf: np.ndarray) -> np.ndarray:
    row = np.zeros(len(idf), np.float64)
    for place, n in counts.items():
        row[place] = (1.0 + math.log(n)) * idf[place]
    length = np.sqrt((row * row).sum())
    return row / length if length else row


def sample_examples(docs: DataFrame, labels: DataFrame, max_examples: int = MAX_EXAMPLES) -> DataFrame:
    """(doc_id, toxic, text): at most ``max_examples`` labelled ids, chosen by their hash.

    An id that carries both labels counts as toxic; null labels and ids teach nothing.
    Repeated rows of a document are one example each.
    """
    chosen = (labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_examples))
    # At most max_examples light rows.
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(
        "doc_id", "toxic", F.coalesce("text", F.lit("")).alias("text"))


def _select_terms(examples: DataFrame, max_terms: int, least_g: float) -> tuple[list[str], int, int]:
    """The most telling terms of the sample, and the numbers of toxic and other examples."""
    def rows(part: dict[str, list]) -> Iterator[tuple]:
        seen: dict[str, list[int]] = {}
        memo = Memo(terms_of, 100_000)
        for toxic, text in zip(part["toxic"], part["text"]):
            for term in {t for w in set(words_of(text)) for t in memo[w]}:
                seen.setdefault(term, [0, 0])[toxic != 0] += 1
        for term, (other, toxic) in seen.items():
            yield term, toxic, other

    sizes = examples.agg(F.sum((F.col("toxic") != 0).cast("long")), F.count(F.lit(1))).first()
    n_toxic, n_all = sizes[0] or 0, sizes[1]
    n_other = n_all - n_toxic
    if not n_toxic or not n_other:
        return [], n_toxic, n_other
    a, b = F.col("toxic"), F.col("other")

    def part_of_g(seen, row_total, column_total):
        expected = row_total * F.lit(float(column_total)) / F.lit(float(n_all))
        return F.when(seen > 0, 2 * seen * F.log(seen / expected)).otherwise(0.0)

    present, absent = a + b, F.lit(n_all) - a - b
    g = (part_of_g(a, present, n_toxic) + part_of_g(b, present, n_other)
         + part_of_g(F.lit(n_toxic) - a, absent, n_toxic)
         + part_of_g(F.lit(n_other) - b, absent, n_other))
    counts = (map_rows(examples, "term string, toxic long, other long", rows, 2048)
              .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")))
    best = (counts.where(a > 2).where(a * n_other > b * n_toxic)
            .withColumn("g", g).where(F.col("g") >= least_g)
            .orderBy(F.desc("g"), "term").limit(max_terms))
    return [r.term for r in best.collect()], n_toxic, n_other  # at most max_terms rows


def learn(docs: DataFrame, labels: DataFrame, max_examples: int = MAX_EXAMPLES,
          max_terms: int = MAX_TERMS, least_g: float = LEAST_G) -> Model:
    """Fit the space on the sample, count its terms in all of ``docs``, index the examples.

    ``labels`` has (doc_id, toxic) of the rows to learn from. Without both classes every
    score is the share of toxic labels, 0 without labels.
    """
    examples = sample_examples(docs, labels, max_examples)
    chosen, n_toxic, n_other = _select_terms(examples, max_terms, least_g)
    terms = {t: i for i, t in enumerate(sorted(chosen))}
    prior = n_toxic / max(1, n_toxic + n_other)
    if not terms:
        return Model({}, np.zeros(0), np.zeros(0, np.int64), np.zeros(0), np.zeros((0, 0)),
                     np.zeros((0, 0)), prior, prior)
    places = Memo(lambda w: [terms[t] for t in terms_of(w) if t in terms])

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents with each term, and documents, of one task."""
        found = np.zeros(len(terms) + 1, np.int64)
        for batch in batches:
            for text in batch.column(0):
                body = text.as_py()
                found[list({p for w in set(words_of(body)) for p in places[w]})] += 1
                found[-1] += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(found))), pa.array(found)],
                                         names=["place", "n"])

    counted = dict(docs.select("text").mapInArrow(present, "place long, n long")
                   .groupBy("place").agg(F.sum("n")).collect())  # one row for each term
    total = counted.get(len(terms), 0)
    idf = np.array([math.log((1 + total) / (1 + counted.get(i, 0))) + 1 for i in range(len(terms))])

    def vectors(part: dict[str, list]) -> Iterator[tuple]:
        for doc_id, toxic, text in zip(part["doc_id"], part["toxic"], part["text"]):
            counts = Counter(p for w in words_of(text) for p in places[w])
            yield doc_id, toxic, list(counts), list(counts.values())

    sampled = (map_rows(examples, "doc_id long, toxic int, places array<int>, counts array<int>", vectors)
               .collect())  # at most max_examples rows of at most max_terms entries
    sampled.sort(key=lambda r: (tuple(sorted(r.places)), r.doc_id))  # like vectors share blocks
    empty = [r for r in sampled if not r.places]
    kept = [r for r in sampled if r.places]
    weights = np.array([_vector(dict(zip(r.places, r.counts)), idf) for r in kept]).reshape(
        len(kept), len(terms))
    blocks = -(-len(kept) // BLOCK)
    block_max = np.array([weights[b * BLOCK:(b + 1) * BLOCK].max(axis=0)
                          for b in range(blocks)]).reshape(blocks, len(terms)).T
    share = (sum(r.toxic != 0 for r in empty) + SHRINK * prior) / (len(empty) + SHRINK)
    return Model(terms, idf, np.array([r.doc_id for r in kept], np.int64),
                 np.array([float(r.toxic != 0) for r in kept]), weights, np.ascontiguousarray(block_max),
                 prior, share)


def nearest(model: Model, places: np.ndarray, query: np.ndarray,
            k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
    """(examples, cosines) of the k nearest; of equal cosines the lower index wins."""
    bound = query @ model.block_max[places]
    best, at = np.zeros(0), np.zeros(0, np.int64)
    order = np.argsort(-bound, kind="stable")
    for block in order:
        if len(best) >= k and bound[block] < best[k - 1] - 1e-9:
            break
        start = block * BLOCK
        found = model.weights[start:start + BLOCK, places] @ query
        best = np.concatenate((best, found))
        at = np.concatenate((at, np.arange(start, start + len(found))))
        top = np.lexsort((at, -best.round(9)))[:k]
        best, at = best[top], at[top]
    return at, best


def score(model: Model, counts: dict[int, int], k: int = NEIGHBOURS) -> tuple[float, list[int]]:
    """Vote of the nearest examples and their ids."""
    if not counts or not len(model.ids):
        return model.empty, []
    row = _vector(counts, model.idf)
    places = np.flatnonzero(row)
    at, cosine = nearest(model, places, row[places], k)
    at, cosine = at[cosine > 0], cosine[cosine > 0]
    vote = float((cosine * model.toxic[at]).sum() + SHRINK * model.prior) / float(cosine.sum() + SHRINK)
    return min(1.0, max(0.0, vote)), model.ids[at[:5]].tolist()


def classify(docs: DataFrame, model: Model, k: int = NEIGHBOURS, threshold: float = THRESHOLD,
             text: str = "text", keep_text: bool = False) -> DataFrame:
    """``docs`` with ``score``, ``predicted`` and ``evidence`` (ids of nearest examples).

    Null and empty texts get the score of texts without telling terms. ``text`` itself
    is left out unless ``keep_text``. Columns of these names are replaced.
    """
    rest = [c for c in docs.columns if c not in ("score", "predicted", "evidence", text)]
    kept = [*rest, text] if keep_text else rest
    schema = docs.select(*kept, F.lit(0.0).alias("score"), F.lit(0).alias("predicted"),
                         F.array(F.lit(0).cast("bigint")).alias("evidence")).schema
    places = Memo(lambda w: [model.terms[t] for t in terms_of(w) if t in model.terms])
    known = Memo(lambda key: score(model, dict(key), k), 50_000)

    def rows(part: dict[str, list]) -> Iterator[tuple]:
        for *row, body in zip(*part.values()):
            counts = Counter(p for w in words_of(body) for p in places[w]) if model.terms else {}
            value, ids = known[tuple(sorted(counts.items()))]
            yield (*row, *([body] if keep_text else []), value, int(value >= threshold), ids)

    return map_rows(docs.select(*rest, F.col(text).alias("_text")), schema, rows)
