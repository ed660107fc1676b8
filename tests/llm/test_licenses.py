import re

import pytest

from corvane.llm import licenses


def words(text):
    return re.findall(r"[^\W_]+", text.lower())


def bigrams(text):
    w = words(text)
    return set(zip(w, w[1:]))


def plain(text, templates, least):
    """(license, dice, licenses, n_matches) by comparing every unit with every template."""
    hits = []
    for unit in set((text or "").split("\n")) | set(re.split(r"\n[ \t\r]*\n", text or "")):
        a = bigrams(unit)
        best = (0.0, "")
        for name, body in templates:
            b = bigrams(body)
            dice = 2 * len(a & b) / (len(a) + len(b)) if a else 0.0
            if dice > best[0] or (dice == best[0] and name < best[1]):
                best = (dice, name)
        if best[0] >= least:
            hits.append(best)
    hits.sort(key=lambda h: (-h[0], h[1]))
    top = hits[0] if hits else (0.0, None)
    return top[1], round(top[0], 6), ",".join(sorted({n for _, n in hits})), len(hits)


CASES = [
    None, "", "\n\n", "one", "Released under the MIT License.", "released UNDER the mit license",
    "x\nLicensed under CC BY-NC 4.0.\nLicensed under CC BY 4.0.\ny",
    "This work is licensed under the GNU General Public License, version 2",
    "prefix words that do not belong\nRedistribution and use in source and binary\nforms, with or without\n"
    "modification, are permitted provided that the following conditions are met:\nsuffix",
    "intro\n\nRedistribution and use in source and binary\nforms, with or without\n"
    "modification, are permitted provided that the following conditions are met:\n \nend",
    "All rights reserved.\nAll rights reserved", "license " * 100_000, "the of and under the license",
]


@pytest.mark.parametrize("least", [0.5, 0.8, 1.0])
def test_by_definition(spark, least):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(CASES)] + [(0, CASES[4], None), (None, "x y", "")],
                                 "doc_id long, text string, license string")
    got = sorted(((r.doc_id, r.license, r.dice, r.licenses, r.n_matches)
                  for r in licenses.scan(docs, least).collect()), key=repr)
    want = sorted(((r.doc_id, *plain(r.text, licenses.TEMPLATES, least)) for r in docs.collect()), key=repr)
    assert got == want
    assert licenses.scan(docs.limit(0)).count() == 0


def test_own_templates(spark):
    docs = spark.createDataFrame([(1, "use it as you like")], "doc_id long, text string")
    got = licenses.scan(docs, templates=[("Free", "Use it as you like!")]).first()
    assert (got.license, got.dice) == ("Free", 1.0)
    with pytest.raises(ValueError):
        licenses.scan(docs, templates=[("None", "word")])
