import math
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest

from corvane.llm import ppm
from corvane.llm.common import held_out, learnt

TEXTS = {"en": ["the cat sat on the mat the end", "that thin thing then"],
         "fr": ["le chat est sur le tapis là", "les chats et les chiens, où ça"]}


def counted(texts, order):
    rows = []
    for lang, bodies in texts.items():
        for size in range(1, order + 2):
            n = Counter()
            for body in bodies:
                data = body.encode()
                n.update(int.from_bytes(data[i:i + size], "big") for i in range(len(data) - size + 1))
            rows += [(lang, size, g, c) for g, c in n.items()]
    return pd.DataFrame(rows, columns=["lang", "size", "gram", "n"])


def plain_code_length(counts, lang, data, order):
    """Bits by the definition, byte after byte."""
    seen = defaultdict(dict)
    for row in counts[counts.lang == lang].itertuples():
        gram = row.gram.to_bytes(row.size, "big")
        seen[gram[:-1]][gram[-1]] = row.n
    bits = 0.0
    for i, byte in enumerate(data):
        for size in range(min(order, i), -1, -1):
            after = seen.get(bytes(data[i - size:i]))
            if after:
                total = sum(after.values()) + len(after)
                if byte in after:
                    bits -= math.log2(after[byte] / total)
                    break
                bits -= math.log2(len(after) / total)
        else:
            bits += 8
    return bits


@pytest.mark.parametrize("order", [1, 2, 4])
@pytest.mark.parametrize("piece", [5, 1 << 19])
def test_code_lengths_by_definition(order, piece, monkeypatch):
    monkeypatch.setattr(ppm, "PIECE", piece)
    counts = counted(TEXTS, order)
    model = ppm.freeze(counts, order)
    texts = ["the chat", "", "q", "où est le chat, then?", "\x00\xff zzz", "thing", "", "à"]
    data = [t.encode() for t in texts]
    ends = np.cumsum([len(d) for d in data])
    got = ppm.code_lengths(model, np.frombuffer(b"".join(data), np.uint8), ends)
    for row, body in zip(got, data):
        want = [plain_code_length(counts, lang, body, order) for lang in model.languages]
        assert np.allclose(row, want, rtol=1e-4, atol=1e-3)


def test_rows_of_any_kind(spark):
    model = ppm.freeze(counted(TEXTS, 3), 3)
    docs = spark.createDataFrame(
        [(1, "the cat on the mat", "x"), (2, None, "x"), (3, "", "x"), (4, "12 ?!", "x"),
         (5, "les chiens et les chats", "x"), (5, "les chiens et les chats", "x"),
         (None, "the end", None), (7, "the mat " * 90_000, "x")],
        "doc_id long, text string, lang_pred string")
    got = sorted(((r.doc_id or 0, r.lang_pred, r.score) for r in ppm.predict(docs, model).collect()))
    assert [g[:2] for g in got] == [(0, "en"), (1, "en"), (2, "und"), (3, "und"), (4, "und"),
                                    (5, "fr"), (5, "fr"), (7, "en")]
    assert all((s == 0) == (p == "und") and 0 <= s <= 1 for _, p, s in got)
    assert ppm.predict(docs.limit(0), model).count() == 0
    nothing = ppm.learn(spark.createDataFrame([], "lang string, text string"))
    assert {r.lang_pred for r in ppm.predict(docs, nothing).collect()} == {"und"}


def test_sample_takes_each_language(spark):
    rows = [("en", f"text {i}") for i in range(300)] + [("fr", "le"), ("fr", "le"), (None, "x"), ("de", None)]
    got = Counter(r.lang for r in ppm.sample_by_language(
        spark.createDataFrame(rows, "lang string, text string"), 60).collect())
    assert 30 <= got["en"] <= 100 and got["fr"] == 1 and len(got) == 2


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = ppm.learn(docs.where(learnt()).select("lang", "text"))
    found = ppm.predict(docs.where(held_out()).select("doc_id", "lang", "text"), model).toPandas()
    assert (found.lang == found.lang_pred).mean() > 0.97


def test_trees_are_bounded_for_each_language(spark):
    """A large language takes nothing from a small one; bytes of every language stay."""
    many = [("en", f"{i} the cat sat on the mat and thought of {i * 7919} things") for i in range(200)]
    few = [("fr", "le chat, le chien, le chat"), ("de", "ab")]
    frame = spark.createDataFrame(many + few, "lang string, text string")
    counts = counted({"en": [t for _, t in many], "fr": [few[0][1]], "de": [few[1][1]]}, 4)
    asked = []
    for limit in (1, 40, 100_000):
        model = ppm.learn(frame, docs_per_language=100_000, max_grams=limit)
        want = []
        for _, own in counts.groupby("lang"):
            least = [m for m in set(own.n) if m > 1 and (own.n >= m).sum() <= limit]
            want.append(own[(own["size"] == 1) | (own.n >= min(least, default=math.inf))])
        whole = ppm.freeze(pd.concat(want), 4)
        assert model.languages == ["de", "en", "fr"]
        assert np.array_equal(model.cost, whole.cost) and np.array_equal(model.open_cost, whole.open_cost)
        asked.append(len(model.cost))
    assert asked == sorted(set(asked))


def test_letters_by_isalpha(spark):
    model = ppm.freeze(counted(TEXTS, 3), 3)
    docs = spark.createDataFrame(list(enumerate(["\u00b2", "\u00bd \u2460", "12 \u00b2 a", "\u00e0"])), "doc_id long, text string")
    got = {r.doc_id: r.lang_pred for r in ppm.predict(docs, model).collect()}
    assert got[0] == got[1] == "und" and "und" not in (got[2], got[3])
