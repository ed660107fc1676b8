import random
import re

import numpy as np
import pytest

from corvane.llm import decontaminate as dec
from corvane.llm.common import Memo

WORDS = "river stone cloud green walk table house garden letter window music paper morning silver".split()


def plain_tokens(text):
    """(reading with marks as starts, reading without): (template token, value) by the rules."""
    out, opening, mark = [], True, False
    for token in re.findall(r"""[.!?\n]|\d[\d.,]*|[^\W\d_]+|[:\"“«(\[]|(?<!\w)['‘–—-]""", text or ""):
        if token in ".!?\n":
            opening, mark = True, False
            continue
        if not token[0].isalnum():
            mark = True
            continue
        low = token.lower()
        if token[0].isdigit() or low in dec.NUMBER_WORDS:
            one = other = "#num"
        elif low in dec.UNITS:
            one = other = "#unit"
        elif len(token) > 1 and token.isupper():
            one = other = "#name"
        else:
            one = "#name" if token[0].isupper() and not (opening or mark) else low
            other = "#name" if token[0].isupper() and not opening else low
        value = low.rstrip(".,") if token[0].isdigit() else low
        out.append(((one, value), (other, value)))
        opening, mark = token[0].isdigit() and token[-1] == ".", False
    return [pair[0] for pair in out], [pair[1] for pair in out]


def cuts(text, width):
    """Windows of both readings by place."""
    one, other = plain_tokens(text)
    return [(one[i:i + width], other[i:i + width]) for i in range(len(one) - width + 1)]


def plain(rows, items, window=dec.WINDOW, least=dec.LEAST_FIXED):
    indexed = []
    for item_id, text in items:
        width = min(window, len(plain_tokens(text)[0]))
        if item_id is not None and width:
            indexed += [(item_id, width, reading) for both in cuts(text, width) for reading in both]
    out = []
    for doc_id, text in rows:
        hits, changed = {}, {}
        for width in {w for _, w, _ in indexed}:
            for both in cuts(text, width):
                matched = {}
                for item_id, w, theirs in indexed:
                    for own in both if w == width else ():
                        same = [v for _, v in own] == [v for _, v in theirs]
                        alike = ([t for t, _ in own] == [t for t, _ in theirs]
                                 and sum(t[0] != "#" for t, _ in own) >= min(least, width))
                        pairs = [{(a[1], b[1]) for a, b in zip(own, theirs) if a[0] == slot}
                                 for slot in ("#num", "#unit", "#name")]
                        if same or alike and all(
                                len(p) == len({a for a, _ in p}) == len({b for _, b in p}) for p in pairs):
                            matched[item_id] = matched.get(item_id, False) or same
                for item_id, same in matched.items():
                    hits[item_id] = hits.get(item_id, 0) + 1
                    changed[item_id] = changed.get(item_id, 0) + (not same)
        out.append((doc_id, bool(hits), len(hits), sum(hits.values()), sum(changed.values()),
                    ",".join(map(str, sorted(hits)))))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.doc_id, r.contaminated, r.n_items, r.n_hits, r.n_changed, r.items)
                   for r in df.collect()), key=repr)


def frames(spark, rows, items):
    return (spark.createDataFrame(rows, "doc_id long, text string"),
            spark.createDataFrame(items, "item_id long, text string"))


def question(rng, name, n, unit):
    head = " ".join(rng.choice(WORDS) for _ in range(6))
    return f"The {head} of {name} has {n} {unit}, and {name} adds {n} {unit} to the {rng.choice(WORDS)} again."


@pytest.mark.parametrize("limit", ["-1", "10MB"])
def test_by_definition(spark, limit, monkeypatch):
    """With the table of hashes sent to tasks and with both sides shuffled."""
    monkeypatch.setattr(dec, "CHUNK", 5)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    rng = random.Random(3)
    items, rows = [], []
    for i in range(12):
        seed = rng.random()
        items.append((i, question(random.Random(seed), "Tom", 3, "kg")))
        other = question(random.Random(seed), rng.choice(["Ann", "Tom"]), rng.choice([3, 17]), "miles")
        if i % 3 == 0:
            other = other.replace("miles to", "hours to")  # slots that contradict each other
        rows.append((i, " ".join(rng.choice(WORDS) for _ in range(30)) + ".\n" + other + " " + rng.choice(WORDS)))
    items += [(50, "Short item of words"), (51, "3 4 5"), (52, None), (53, ""), (None, rows[0][1])]
    rows += [(100, None), (101, ""), (102, "x short ITEM"), (103, "a short item of words b"), (104, "1 3 4 5 9"),
             (105, "7 8 9"), (0, rows[0][1])]
    docs, bench = frames(spark, rows, items)
    try:
        assert result(dec.report(docs, bench)) == plain(rows, items)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("most", [1, 7, 10_000])
def test_groups_of_texts(monkeypatch, most):
    """Windows of texts looked at together are those of each text alone."""
    monkeypatch.setattr(dec, "GROUP_TOKENS", most)
    rng = random.Random(8)
    pieces = ["Tom", "Ann", "3", "kg", "walk", "Walk", ":", '"', ".", "\n", "- ", "4.", "LOUD", "é"]
    texts = [None, "", "."] + [" ".join(rng.choice(pieces) for _ in range(rng.randint(0, 25))) for _ in range(40)]
    memo, got = Memo(dec._packed), {}
    for first, tokens in dec.groups(texts, memo):
        for kinds, places, hashes in dec.readings(tokens, 3):
            for of, h in zip(tokens.of[places], hashes.tolist()):
                got.setdefault(first + int(of), []).append(h)
    want = {}
    for i, text in enumerate(texts):
        tokens = dec.canonical([np.array([dec._packed(t) for t in dec.TOKEN.findall(text or "")], np.uint64)])
        found = [h for _, _, hashes in dec.readings(tokens, 3) for h in hashes.tolist()]
        want |= {i: found} if found else {}
    assert {i: sorted(v) for i, v in got.items()} == {i: sorted(v) for i, v in want.items()}


def test_copies_in_any_letter_case(spark):
    item = "What is the total weight of Tom and Ann in kg?"
    long_item = "A baker named Joe sells 40 rolls to Ann and 30 rolls to Joe in Rome every day of the week."
    rows = [(i, before + form(text) + " and more") for i, (form, before, text) in enumerate(
        [(f, b, t) for t in (item, long_item) for f in (str, str.upper, str.lower)
         for b in ("", "Q: ", '"', "- ", "see (", "Words before. ")])]
    rows += [(900, 'Q: What is the total weight of Bob and Eve in pounds?'), (901, "Q: What is the colour of Tom?")]
    docs, bench = frames(spark, rows, [(1, item), (2, long_item)])
    got = result(dec.report(docs, bench))
    assert got == plain(rows, [(1, item), (2, long_item)])
    assert {r[0] for r in got if r[1]} == {r[0] for r in rows} - {901}
    assert [r[3:5] for r in got if r[0] == 900] == [(1, 1)]


def test_whole_long_texts(spark):
    item = "Every day Joe sells 5 ripe apples for 3 dollars each at the old market."
    docs, bench = frames(spark, [(1, "word " * 200_000 + "\n" + item), (2, "word " * 200_000)], [(1, item)])
    assert {r.doc_id: r.contaminated for r in dec.report(docs, bench).collect()} == {1: True, 2: False}


def test_reparameterised_question(spark):
    docs, bench = frames(
        spark,
        [(1, "Every day Ann sells twelve ripe apples for 4 dollars each at the old market near Paris."),
         (2, "Every day Bob sells 99 ripe apples for 2.50 euros each at the old market near Rome."),
         (3, "Every day Bob buys 99 ripe pears for 2.50 euros each at the new market near Rome.")],
        [(7, "Every day Joe sells 5 ripe apples for 3 dollars each at the old market near Lyon.")])
    got = {r.doc_id: (r.contaminated, r.n_changed > 0) for r in dec.report(docs, bench).collect()}
    assert got == {1: (True, True), 2: (True, True), 3: (False, False)}


def test_empty_tables_and_extra_columns(spark):
    docs, bench = frames(spark, [(1, "a b c"), (None, None)], [(1, "q r s")])
    assert {r.contaminated for r in dec.report(docs, bench.limit(0)).collect()} == {False}
    assert dec.report(docs.limit(0), bench).count() == 0
    from pyspark.sql import functions as F
    wide = docs.withColumn("matches", F.lit(3)).withColumn("item_id", F.lit("x")).withColumn("hits", F.lit(0))
    assert dec.annotate(wide, bench.withColumn("doc_id", F.lit(1))).columns == [
        "doc_id", "text", "item_id", "hits", "matches"]
    assert dec.annotate(wide, bench).count() == 2
    odd = ["key", "h", "a.b", "a", "b", "row", "asked", "found", "at", "own", "theirs", "kinds", "width", "exact"]
    wide = docs.select("*", *[F.lit(i).alias(c) for i, c in enumerate(odd)])
    got = dec.annotate(wide, bench).collect()
    assert {tuple(r)[2:-1] for r in got} == {tuple(range(len(odd)))} and len(got) == 2


def test_planted_passages(spark):
    """Every whole benchmark item in a document is found; documents without any are clean."""
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    texts = {r.item_id: r.text for r in bench.collect()}
    marked = {r.doc_id: r for r in dec.report(docs, bench).collect()}
    for r in docs.collect():
        whole = {str(i) for i, t in texts.items() if t in r.text}
        assert whole <= set(marked[r.doc_id]["items"].split(","))
    assert 0 < sum(r.contaminated for r in marked.values()) < 200
