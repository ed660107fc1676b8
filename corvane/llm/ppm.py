"""Language identification by prediction by partial matching.

For every language a byte context tree of variable order is counted on a sample of
its texts and then frozen. Symbol ``s`` after context ``c`` costs ``-log2 n(c,s) /
(t(c) + u(c))`` bits when ``s`` was seen there (``t`` symbols, ``u`` different ones), else
the escape ``-log2 u(c) / (t(c) + u(c))`` plus its cost after the next shorter context;
below the empty context all 256 bytes are equally likely (method C, no exclusion).
The language with the least total code length wins.

Because the statistics are frozen, the cost of a position depends only on the
longest stored string that ends there: costs of all languages are laid out in one
table by that string, and a text's code lengths are a sum of table rows. The
strings are found for all positions at once by walking dense child tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

UNKNOWN = "und"
ORDER = 4
SAMPLE_DOCS = 400
MAX_GRAMS = 40_000
PIECE = 1 << 19


def sample_by_language(train: DataFrame, docs_per_language: int = SAMPLE_DOCS) -> DataFrame:
    """(lang, text): about ``docs_per_language`` different texts of each language.

    The documented bound of the learning sample. Texts are chosen by their hash, so
    the choice doesn't depend on partitions; copies of a text count once. Null
    languages and null or empty texts teach nothing.
    """
    known = (train.select("lang", "text").where("lang IS NOT NULL AND text <> ''")
             .withColumn("h", F.xxhash64("text")))
    sizes = known.groupBy("lang").agg(F.approx_count_distinct("h").alias("n"))
    share = F.pmod("h", F.lit(1 << 30)) / F.lit(1 << 30)
    return (known.join(F.broadcast(sizes), "lang")  # one row for each language
            .where(share < F.lit(docs_per_language) / F.col("n"))
            .dropDuplicates(["lang", "h"]).select("lang", "text"))


def _grams(order: int):
    """Distinct byte strings of 1 .. order + 1 bytes in each text, as (lang, length, gram, n)."""
    schema = pa.schema([("lang", pa.string()), ("size", pa.int32()), ("gram", pa.int64()),
                        ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = np.frombuffer(text.encode(), np.uint8).astype(np.int64)
                gram = data
                for size in range(1, order + 2):
                    if size > 1:
                        gram = (gram[:-1] << 8) | data[size - 1:]
                    if not len(gram):
                        break
                    found, n = np.unique(gram, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(found), pa.string()),
                         pa.array(np.full(len(found), size, np.int32)),
                         pa.array(found), pa.array(n.astype(np.int64))], schema=schema)

    return run


@dataclass
class Model:
    """Frozen statistics: languages, symbol classes, child tables and costs by string."""

    languages: list[str]
    order: int
    symbol: np.ndarray          # byte -> class, 0 for bytes never seen
    classes: int
    children: list[np.ndarray]  # by string length: (node * classes + class) -> longer node, 0 none
    first: list[int]            # by string length: id of that level's node 0
    cost: np.ndarray            # by id and language: the term to be summed
    open_cost: np.ndarray       # by id and language: escapes prepaid for the next byte


def learn(train: DataFrame, order: int = ORDER, docs_per_language: int = SAMPLE_DOCS,
          max_grams: int = MAX_GRAMS) -> Model:
    """Count the strings of the sample on the cluster and freeze the trees.

    Strings of a language seen fewer than m times are left out; m is the least number
    above 1 that keeps at most ``max_grams`` strings of that language. All single bytes
    stay, so every language of the sample is in the model, however small it is. The driver
    holds at most ``max_grams`` strings and 256 bytes for each language of the sample.
    A string's prefixes and suffixes are at least as frequent, so they stay too.
    """
    counts = (sample_by_language(train, docs_per_language)
              .mapInArrow(_grams(order), "lang string, size int, gram long, n long")
              .groupBy("lang", "size", "gram").agg(F.sum("n").alias("n")))
    # How many strings of the language are seen at least as often, those tied included.
    often = counts.where("n > 1").groupBy("lang", "n").agg(F.count(F.lit(1)).alias("strings"))
    reached = F.sum("strings").over(Window.partitionBy("lang").orderBy(F.desc("n")))
    least = (often.withColumn("reached", reached).where(F.col("reached") <= max_grams)
             .groupBy("lang").agg(F.min("n").alias("least")))
    top = (counts.join(F.broadcast(least), "lang", "left")  # one row for each language
           .where("size = 1 OR n >= least").select("lang", "size", "gram", "n").toPandas())
    return freeze(top, order)


def freeze(counts, order: int) -> Model:
    """The model of (lang, size, gram, n) counts."""
    languages = sorted(counts["lang"].unique().tolist())
    place = {lang: i for i, lang in enumerate(languages)}
    width = max(1, len(languages))
    by_size: list[dict[int, np.ndarray]] = [{} for _ in range(order + 2)]
    for lang, size, gram, n in zip(counts["lang"], counts["size"], counts["gram"], counts["n"]):
        row = by_size[size].get(gram)
        if row is None:
            row = by_size[size][gram] = np.zeros(width)
        row[place[lang]] = n
    by_size = [dict(sorted(level.items())) for level in by_size]

    def context_totals(size: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """Symbols and different symbols seen after each context of ``size - 1`` bytes."""
        out: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for gram, row in by_size[size].items():
            t, u = out.setdefault(gram >> 8, (np.zeros(width), np.zeros(width)))
            t += row
            u += row > 0
        return out

    symbol = np.zeros(256, np.int64)
    for c, gram in enumerate(by_size[1]):
        symbol[gram] = c + 1
    classes = len(by_size[1]) + 1
    node: list[dict[int, int]] = [{}] + [{g: i + 1 for i, g in enumerate(level)}
                                        for level in by_size[1:]]
    # At length 1 node 0 stands for bytes that no language has.
    first, total = [0, 0], classes
    for size in range(2, order + 2):
        first.append(total - 1)  # node 0 means no string of this length
        total += len(by_size[size])
    children = [np.zeros(0, np.int32)]
    for size in range(1, order + 1):
        table = np.zeros((len(by_size[size]) + 1) * classes, np.int32)
        for gram, i in node[size + 1].items():
            table[node[size][gram >> 8] * classes + symbol[gram & 255]] = i
        children.append(table)

    resolved = np.zeros((total, width))   # cost of the last byte after the rest of the string
    escapes = np.zeros((total, width))    # escapes from the string, as a context, down to length 1
    for size in range(1, order + 2):
        seen = context_totals(size)
        keep = (1 << 8 * (size - 1)) - 1
        if size == 1:
            t, u = seen.get(0, (np.zeros(width), np.zeros(width)))
            escape = np.where(t > 0, -np.log2(np.maximum(u, 1) / np.maximum(t + u, 1)), 0.0)
            resolved[0] = escape + 8
            for gram, row in by_size[1].items():
                resolved[node[1][gram]] = np.where(
                    row > 0, -np.log2(np.maximum(row, 1) / np.maximum(t + u, 1)), escape + 8)
            continue
        for gram, (t, u) in seen.items():
            own = first[size - 1] + node[size - 1][gram]
            escape = np.where(t > 0, -np.log2(np.maximum(u, 1) / np.maximum(t + u, 1)), 0.0)
            shorter = 0.0
            if size > 2:
                shorter = escapes[first[size - 2] + node[size - 2][gram & (keep >> 8)]]
            escapes[own] = escape + shorter
        for gram, row in by_size[size].items():
            t, u = seen[gram >> 8]
            own = first[size - 1] + node[size - 1][gram >> 8]
            suffix = first[size - 1] + node[size - 1][gram & keep]
            escape = np.where(t > 0, -np.log2(np.maximum(u, 1) / np.maximum(t + u, 1)), 0.0)
            resolved[first[size] + node[size][gram]] = np.where(
                row > 0, -np.log2(np.maximum(row, 1) / np.maximum(t + u, 1)),
                escape + resolved[suffix])
        for gram in by_size[size - 1]:  # contexts nothing follows keep the shorter ones' escapes
            own = first[size - 1] + node[size - 1][gram]
            if gram not in seen and size > 2:
                escapes[own] = escapes[first[size - 2] + node[size - 2][gram & (keep >> 8)]]
    cost, open_cost = np.zeros((total, width)), np.zeros((total, width))
    cost[0] = resolved[0]
    for size in range(1, order + 2):
        keep = (1 << 8 * order) - 1
        for gram, i in node[size].items():
            own = first[size] + i
            after = min(size, order)
            open_cost[own] = escapes[first[after] + node[after][gram & keep]]
            paid = escapes[first[size - 1] + node[size - 1][gram >> 8]] if size > 1 else 0.0
            cost[own] = resolved[own] - paid + open_cost[own]
    return Model(languages, order, symbol, classes, children, first,
                 cost.astype(np.float32), open_cost.astype(np.float32))


def code_lengths(model: Model, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Bits of each text under each language; ``ends`` are the texts' ends in ``data``.

    Works through ``data`` in pieces that overlap by the order, whatever the texts' lengths.
    """
    starts = np.concatenate(([0], ends[:-1]))
    bits = np.zeros((len(ends), len(model.languages)))
    filled = np.flatnonzero(ends > starts)
    at_start, at_end = starts[filled], ends[filled]
    for begin in range(0, len(data), PIECE):
        left, right = max(0, begin - model.order), min(len(data), begin + PIECE)
        s = model.symbol[data[left:right]]
        inner = at_start[(at_start >= left) & (at_start < right)] - left
        node = s
        longest = s
        for size in range(2, model.order + 2):
            longer = np.zeros(len(s), np.int64)
            longer[1:] = model.children[size - 1][node[:-1] * model.classes + s[1:]]
            longer[inner] = 0
            longest = np.where(longer > 0, longer + model.first[size], longest)
            node = longer
        longest = longest[begin - left:]
        touched = np.arange(np.searchsorted(at_end, begin, "right"),
                            np.searchsorted(at_start, right, "left"))
        cuts = np.maximum(at_start[touched] - begin, 0)
        bits[filled[touched]] += np.add.reduceat(model.cost[longest], cuts, axis=0, dtype=np.float64)
        closing = touched[at_end[touched] <= right]
        bits[filled[closing]] -= model.open_cost[longest[at_end[closing] - 1 - begin]]
    return bits


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` without ``text``, with lang_pred and score.

    ``score`` is the posterior of the winner with equal priors, 0 for ``und``: a null
    text or one without a letter by ``str.isalpha`` (raised digits and fractions are none).
    Ties go to the language first in the alphabet. A model without languages answers
    ``und`` everywhere.
    """
    rest = [c for c in docs.columns if c not in (text, "lang_pred", "score")]
    frame = docs.select(*rest, F.col(text).alias("_text"))
    schema = docs.select(*rest, F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            names = np.full(len(texts), UNKNOWN, object)
            scores = np.zeros(len(texts))
            if model.languages and len(texts):
                texts = texts.fill_null("")
                kind = np.int64 if texts.type == pa.large_string() else np.int32
                offsets = np.frombuffer(texts.buffers()[1], kind)[
                    texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
                ends = offsets[1:] - offsets[0]
                data = (np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
                        if ends[-1] else np.zeros(0, np.uint8))
                bits = code_lengths(model, data, ends)
                best = bits.argmin(axis=1)
                lead = np.exp2(np.maximum(bits.min(axis=1)[:, None] - bits, -1000.0))
                letters = np.array([any(map(str.isalpha, t.as_py())) for t in texts], bool)
                names[letters] = np.array(model.languages, object)[best[letters]]
                scores[letters] = 1.0 / lead.sum(axis=1)[letters]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(names, pa.string()), pa.array(scores)],
                names=[*batch.schema.names[:-1], "lang_pred", "score"])

    return frame.mapInArrow(run, schema)
