"""Secret scanning with ownership frequency, built from DataFrame functions only.

Three base kinds are found by pattern: assignments to a secret's name, access key ids
and runs of hexadecimal digits. Candidate values of the whole corpus, these and other
runs that look generated, are aggregated by hash: how many different owners and
repositories hold the value. A value that owners copy from each other, or that stands in
many repositories, is an example; one that a single owner holds in few looks live. The method adds the spans of generated-looking
values that no base span covers and whose frequency makes them live, as kind ``owned``.

Spans count code points, the end is exclusive. Patterns are matched leftmost and without
overlap: the text is split at the matches, and positions are sums of the lengths of the
pieces and matches before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corvane.plans.scratch import materialize
from corvane.plans.skew import skew_join

# The kinds in the order that breaks ties, and their patterns.
KINDS = ["assign", "access", "hex", "owned"]
ASSIGN = r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_LEAST = 6
# A generated-looking value: 20 or more of these characters with a letter and two digits.
OTHER = r"[A-Za-z0-9+/_-]{20,}"
LETTER, TWO_DIGITS = r"[A-Za-z]", r"[0-9].*[0-9]"
MAX_OWNERS, MAX_REPOSITORIES = 1, 100
CHUNK = 256

_SPAN = "array<struct<kind:int,start:bigint,stop:bigint,value:string>>"


def _spans(text: Column, pattern: str, kind: int, value_group: int = 0) -> Column:
    """Every match of ``pattern`` as (kind, start, stop, value), from left to right.

    An access or hexadecimal match of the least length or more is the same as a
    longer-or-equal match of any length that is kept, as both take whole runs.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = matches if value_group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group))
    pieces = F.split(text, pattern, -1)

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["piece"])
        stop = start + F.length(x["match"])
        return F.struct(
            stop.cast("bigint").alias("at"),
            F.concat(state["found"], F.array(F.struct(
                F.lit(kind).alias("kind"), start.cast("bigint").alias("start"),
                stop.cast("bigint").alias("stop"), x["value"].alias("value")))).alias("found"))

    rows = F.filter(F.arrays_zip(pieces.alias("piece"), matches.alias("match"), values.alias("value")),
                    lambda x: x["match"].isNotNull())
    none = F.array().cast(_SPAN)
    # Appending copies an array, so matches are appended in chunks and chunks to the rest.
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(rows) - 1) / CHUNK).cast("int")),
                         lambda i: F.slice(rows, i * CHUNK + 1, F.lit(CHUNK)))

    def chunk_step(state: Column, chunk: Column) -> Column:
        ended = F.aggregate(chunk, F.struct(state["at"].alias("at"), none.alias("found")), step)
        return F.element_at(F.transform(F.array(ended), lambda e: F.struct(
            e["at"].alias("at"), F.concat(state["found"], F.array(e["found"])).alias("found"))), 1)

    first = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(f"array<{_SPAN}>").alias("found"))
    found = F.aggregate(chunks, first, chunk_step, lambda state: F.flatten(state["found"]))
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(_SPAN))


def _fingerprint(value: Column) -> Column:
    return F.sha2(value, 256)


def scan(docs: DataFrame, owner: str, repository: str, max_owners: int = MAX_OWNERS,
         max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """(doc_id, spans) of each row of ``docs`` (doc_id, text, owner and repository columns).

    ``spans`` holds (kind, start, stop, owners, repositories, live) by start, then kind; base
    spans stay whatever their frequency, with ``live`` telling owner-specific values from
    examples. Values are kept as hashes only. Null texts are empty, and an empty table has
    no rows. A null owner or repository counts as none, so a value without known owner isn't
    live. Rows that repeat an id are scanned each. Very long texts are matched whole.
    Other columns aren't read, whatever their names.
    """
    text = F.coalesce("text", F.lit(""))
    assign = F.filter(_spans(text, ASSIGN, 0, 1), lambda x: F.length(x["value"]) >= ASSIGN_LEAST)
    base = F.concat(assign, _spans(text, ACCESS, 1), _spans(text, HEX, 2))
    other = F.filter(_spans(text, OTHER, 3), lambda x: x["value"].rlike(LETTER)
                     & x["value"].rlike(TWO_DIGITS))
    rows = docs.select("doc_id", F.col(f"`{owner}`").cast("string").alias("owner"),
                       F.col(f"`{repository}`").cast("string").alias("repository"),
                       base.alias("base"), other.alias("other"))
    free = F.filter("other", lambda o: ~F.exists(
        "base", lambda b: (b["start"] < o["stop"]) & (o["start"] < b["stop"])))
    hashed = F.transform(F.concat("base", free), lambda x: F.struct(
        x["kind"].alias("kind"), x["start"].alias("start"), x["stop"].alias("stop"),
        _fingerprint(x["value"]).alias("hash")))
    # One light row for each document: its number tells repeated rows apart.
    found = materialize(
        rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "owner", "repository",
                    hashed.alias("spans")), "secret_spans")
    each = found.select("row", "owner", "repository", F.explode("spans").alias("s")).select(
        "row", "owner", "repository", "s.*")
    known = materialize(ownership(each), "secret_owners")
    # A value copied everywhere meets its one row of counts in as many parts as it has tasks' worth.
    judged = skew_join(each.select("row", "kind", "start", "stop", "hash"), known.drop("n"), ["hash"], known,
                       by=["row", "start"])
    live = F.col("owners").between(1, max_owners) & (F.col("repositories") <= max_repositories)
    span = F.struct("start", "kind", "stop", "owners", "repositories", live.alias("live"))
    kept = (judged.where((F.col("kind") < 3) | live).groupBy("row")
            .agg(F.sort_array(F.collect_list(span)).alias("spans")))
    return (found.select("row", "doc_id").join(kept, "row", "left")
            .select("doc_id", F.coalesce("spans", F.array().cast(kept.schema["spans"].dataType))
                    .alias("spans")))


def ownership(values: DataFrame) -> DataFrame:
    """(hash, owners, repositories, n): how many different owners and repositories hold a value,
    and in how many places it stands.

    Copies inside an owner and repository collapse before the shuffle, so a value found
    everywhere reaches the count as one row for each owner or repository.
    """
    return values.groupBy("hash").agg(
        F.count_distinct("owner").alias("owners"), F.count_distinct("repository").alias("repositories"),
        F.count(F.lit(1)).alias("n"))


def _listed(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts by kind, the hash of the base spans, all spans, and how many look live."""
    def number(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    base = F.filter("spans", lambda s: s["kind"] < 3)
    return found.select(
        "doc_id", number(0).alias("n_assign"), number(1).alias("n_access"), number(2).alias("n_hex"),
        F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"),
        number(3).alias("n_owned"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("bigint").alias("n_live"))
