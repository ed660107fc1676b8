import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from corvane.llm import merkle

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def hashed(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, more=0):
    n_chars = None if row["n_chars"] is None else row["n_chars"] + more
    return hashed(*map(field, (row["doc_id"], row["source"], row["lang"], n_chars, row["text"])))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        last = out[-1]
        out.append([hashed(*last[i:i + 2]) for i in range(0, len(last), 2)])
    return out


def walk(tree, index, node, found):
    for level in tree[:-1]:
        other = index ^ 1
        if other < len(level):
            found.append(level[other])
            node = hashed(level[other], node) if other < index else hashed(node, level[other])
        else:
            node = hashed(node)
        index //= 2
    return node


def plain(rows):
    """The audit by whole levels in memory."""
    groups = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
    trees = {g: levels([leaf(r) for r in groups[g]]) for g in order}
    upper = levels([trees[g][-1][0] for g in order])
    root, out = upper[-1][0], []
    for g in order:
        for i, row in enumerate(groups[g]):
            changed = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 7 == 0
            proof = []
            node = walk(trees[g], i, leaf(row, int(changed)), proof)
            node = walk(upper, order.index(g), node, proof)
            out.append((row["doc_id"], leaf(row), trees[g][-1][0], root, hashed(*proof), node, node == root))
    return sorted(out, key=repr)


def audited(frame, block_levels):
    return sorted(map(tuple, merkle.audit(frame, block_levels).collect()), key=repr)


@pytest.mark.parametrize("leaves", [*range(1, 18), 31, 32, 33, 100])
def test_log_is_in_postorder(leaves):
    """Every node stands where the closed form says, children before their parent."""
    tree = levels([hashed(str(i)) for i in range(leaves)])
    top = merkle.levels_above(leaves)
    log = merkle.append_log([bytes.fromhex(x) for x in tree[0]], top)
    nodes = [log[i:i + 32].hex() for i in range(0, len(log), 32)]
    places = {}
    for h, level in enumerate(tree):
        assert merkle.nodes_on(h, leaves) == len(level)
        for i, node in enumerate(level):
            places[h, i] = place = merkle.place_of(h, i, leaves)
            assert nodes[place] == node
            for child in (2 * i, 2 * i + 1):
                if (h - 1, child) in places:
                    assert places[h - 1, child] < place
    assert sorted(places.values()) == list(range(len(nodes)))


@pytest.mark.parametrize("leaves,top", [(1, 3), (2, 3), (3, 3), (5, 4), (8, 3)])
def test_last_segment_reaches_the_segments_top(leaves, top):
    """A segment with few leaves goes on alone to the level where segments meet."""
    tree = [[hashed(str(i)) for i in range(leaves)]]
    for _ in range(top):
        last = tree[-1]
        tree.append([hashed(*last[i:i + 2]) for i in range(0, len(last), 2)])
    log = merkle.append_log([bytes.fromhex(x) for x in tree[0]], top)
    for h, level in enumerate(tree):
        for i, node in enumerate(level):
            place = merkle.place_of(h, i, leaves)
            assert log[32 * place:32 * place + 32].hex() == node


@pytest.mark.parametrize("block_levels", [1, 4, 12])
def test_documents_table(spark, block_levels):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = plain([r.asDict() for r in docs.collect()])
    assert audited(docs, block_levels) == want
    bad = [r for r in want if not r[-1]]
    assert 0 < len(bad) < len(want) / 4


def test_edge_cases(spark):
    rows = [(1, "a", "en", "s", 1), (1, "a", "en", "s", 1), (None, "b", "en", None, None), (None, None, None, None, None),
            (7, "", "", "x", 0), (8, "ü" * 100_000, "ß", "x", 2**63 - 1), (9, "c", None, "s", None),
            (-3, "z", "en", "", -5)]
    rows += [(i, "same", "de", "hot", 4) for i in range(40)]
    docs = spark.createDataFrame(rows, SCHEMA)
    want = plain([r.asDict() for r in docs.collect()])
    clash = docs.withColumns({c: F.lit("!") for c in (
        "leaf", "proof", "sides", "tree", "place", "root", "subroot", "id_", "group_", "also0_", "a.b")})
    for block_levels in (2, 12):
        assert audited(clash, block_levels) == want


def test_one_row_and_none(spark):
    one = spark.createDataFrame([(5, "x", "en", "s", 1)], SCHEMA)
    found = merkle.audit(one).collect()[0]
    assert found.leaf == found.subroot == found.root
    assert found.proof_sha256 == hashed("")
    none = merkle.audit(spark.createDataFrame([], SCHEMA))
    assert none.collect() == [] and [t for _, t in none.dtypes] == ["bigint"] + ["string"] * 5 + ["boolean"]


def test_proofs_fold_and_a_change_shows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = merkle.manifest(docs, merkle.document_fields(), "lang", "doc_id", block_levels=3).collect()
    assert len(found) == docs.count() and len({r.root for r in found}) == 1
    for r in found[:50]:
        assert merkle.fold(r.leaf, r.proof, r.sides) == r.root
        assert merkle.fold(hashed(r.leaf), r.proof, r.sides) != r.root
        assert len(r.proof) == 64 * sum(s != "-" for s in r.sides)


def test_log_rows(spark):
    leaves = [hashed(str(i)) for i in range(11)]
    frame = spark.createDataFrame([(b"t", i, 11, bytearray.fromhex(x)) for i, x in enumerate(leaves)],
                                  "tree binary, place long, leaves long, digest binary")
    rounds = merkle.grow(frame, 2)
    assert len(rounds) == 2
    assert merkle.roots(rounds).collect()[0].root.hex() == levels(leaves)[-1][0]
    log = merkle.postorder(rounds[0])
    assert log.where("block = 0").count() == 7 and log.where("block = 2").count() == 6
    assert [r.digest for r in log.where("block = 1 AND place < 2").orderBy("place").collect()] == leaves[4:6]
