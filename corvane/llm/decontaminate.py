"""Benchmark decontamination by template canonicalisation.

Texts become sequences of typed tokens: numbers (digits or number words) turn into
``#num``, units of measure into ``#unit``, names (capitalised words that don't begin a
sentence, and all words written in capitals) into ``#name``; other words are folded to
lower case. After a colon, quote, bracket or dash a capitalised word may begin a
sentence or not: windows with such words stand both ways.

Windows of ``WINDOW`` tokens of this template are hashed and hash-joined to the windows of
the benchmark items, so a question is found again with other numbers, names or units. A
window counts when its slots are consistent: equal values of one side must stand against
equal values of the other, one to one, within a type. That holds just when every slot
repeats its value at the same distance on both sides, so these distances inside the
window are part of its hash. Beside its template every window is joined by its exact words,
folded to lower case, so a copy is found in any letter case. Hashes have 64 bits: 10 ** 13 windows
of documents meet 10 ** 6 of items by chance about once in two runs.

An item shorter than the window is one window as a whole. Templates with fewer than
``LEAST_FIXED`` tokens outside slots say nothing about an item; these windows are looked up
by their exact words alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from corvane.llm.common import Memo, map_rows
from corvane.plans.scratch import materialize

WINDOW = 13
LEAST_FIXED = 7
CHUNK = 65_536  # windows of a text that one row holds

# Words that stand for numbers and units.
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen "
    "fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy "
    "eighty ninety hundred thousand million billion dozen half twice".split())
UNITS = frozenset(
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram "
    "kilograms ounce ounces lb lbs pound pounds ton tons ml l liter liters litre litres "
    "gallon gallons second seconds minute minutes hour hours day days week weeks month "
    "months year years meter meters metre metres kilometer kilometers kilometre kilometres "
    "centimeter centimeters percent dollar dollars euro euros cent cents degree degrees "
    "mph kmh watt watts volt volts byte bytes kb mb gb tb".split())

TOKEN = re.compile(r"[.!?\n]|\d[\d.,]*|[^\W\d_]+|[:\"“«(\[]|(?<!\w)['‘–—-]")
ENDS = frozenset(".!?\n")
MARKS = frozenset(":\"“«(['‘–—-")
WORD, NUM, UNIT, NAME = 0, 1, 2, 3
SLOTS = {NUM: "#num", UNIT: "#unit", NAME: "#name"}


PLAIN, END, MARK = 0, 1, 2
GROUP_TOKENS = 200_000  # tokens of several texts that are looked at together


def _packed(token: str) -> int:
    """58 bits of the value's hash, then the kind inside a sentence, the kind at its start, the role."""
    if token in ENDS:
        return END
    if token in MARKS:
        return MARK
    folded, role = token.lower(), PLAIN
    if token[0].isdigit() or folded in NUMBER_WORDS:
        inside = opening = NUM
        role = END if token[0].isdigit() and token[-1] == "." else PLAIN
    elif folded in UNITS:
        inside = opening = UNIT
    elif len(token) > 1 and token.isupper():
        inside = opening = NAME
    else:
        inside, opening = NAME if token[0].isupper() else WORD, WORD
    value = xxhash.xxh3_64_intdigest(folded.rstrip(".,").encode("utf-8", "surrogatepass"))
    return max(value >> 6, 1) << 6 | inside << 4 | opening << 2 | role


_SLOT_HASH = np.array([0] + [xxhash.xxh3_64_intdigest(SLOTS[k]) for k in (NUM, UNIT, NAME)], np.uint64)
_FAR = np.int64(1) << 40


@dataclass
class Tokens:
    """The tokens of several texts: the text each is of, its value and its kinds.

    ``kinds`` takes a word after a mark for the start of a sentence, ``others`` doesn't.
    """

    of: np.ndarray
    values: np.ndarray
    kinds: np.ndarray
    others: np.ndarray


def canonical(packed: list[np.ndarray]) -> Tokens:
    """The tokens of texts given as arrays of packed tokens."""
    of = np.repeat(np.arange(len(packed)), [len(p) for p in packed])
    every = np.concatenate(packed) if packed else np.zeros(0, np.uint64)
    role = every & np.uint64(3)
    after_mark = np.concatenate(([False], role[:-1] == MARK))[:len(of)]
    kept = role != MARK
    of, every, ends, after_mark = of[kept], every[kept], role[kept] == END, after_mark[kept]
    first = np.concatenate(([True], ends[:-1] | (of[1:] != of[:-1])))[:len(of)]
    inside, opening = ((every >> np.uint64(bit) & np.uint64(3)).astype(np.int64) for bit in (4, 2))
    words = every >> np.uint64(6) != 0
    return Tokens(of[words], every[words] >> np.uint64(6), np.where(first | after_mark, opening, inside)[words],
                  np.where(first, opening, inside)[words])


def groups(texts: list[str | None], memo: Memo) -> Iterator[tuple[int, Tokens]]:
    """(number of the first text, tokens) of runs of texts; a text alone may have any length."""
    first, size, packed = 0, 0, []
    for text in texts:
        found = TOKEN.findall(text or "")
        if packed and size + len(found) > GROUP_TOKENS:
            yield first, canonical(packed)
            first, size, packed = first + len(packed), 0, []
        packed.append(np.fromiter(map(memo.__getitem__, found), np.uint64, len(found)))
        size += len(found)
    if packed:
        yield first, canonical(packed)


def repeats(tokens: Tokens, kinds: np.ndarray) -> np.ndarray:
    """How many tokens before each slot its value stood last in a slot of that kind, or ``_FAR``."""
    out = np.full(len(kinds), _FAR)
    slots = np.flatnonzero(kinds != WORD)
    order = slots[np.lexsort((slots, tokens.values[slots], kinds[slots], tokens.of[slots]))]
    same = np.ones(max(0, len(order) - 1), bool)
    for column in (tokens.of, kinds, tokens.values):
        same &= column[order[1:]] == column[order[:-1]]
    out[order[1:][same]] = np.diff(order)[same]
    return out


def window_hashes(tokens: Tokens, kinds: np.ndarray | None, width: int) -> np.ndarray:
    """Hash of every window of ``width`` tokens, by its words or by the template of ``kinds``; each
    width and form has hashes of its own."""
    size = len(tokens.values) - width + 1
    rolled = np.full(max(0, size), np.uint64(2 * width + (kinds is None)))
    if size <= 0:
        return rolled.astype(np.int64)
    plain = bound = tokens.values
    if kinds is not None:
        back = repeats(tokens, kinds)
        plain = np.where(kinds == WORD, tokens.values, _SLOT_HASH[kinds])
        bound = plain + back.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for i in range(width):
        rolled = (rolled ^ (rolled >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        part = slice(i, i + size)
        rolled += plain[part] if kinds is None else np.where(back[part] <= i, bound[part], plain[part])
    return (rolled ^ (rolled >> np.uint64(31))).astype(np.int64)


def readings(tokens: Tokens, width: int) -> Iterator[tuple[np.ndarray | None, np.ndarray, np.ndarray]]:
    """(kinds or None for exact words, places, hashes) of the windows inside one text; those of
    the other kinds only where they differ."""
    places = np.arange(max(0, len(tokens.of) - width + 1))
    whole = tokens.of[places] == tokens.of[places + width - 1]
    sums = np.concatenate(([0], np.cumsum(tokens.kinds != tokens.others)))
    differ = whole & (sums[places + width] > sums[places])
    for kinds, asked in ((None, whole), (tokens.kinds, whole), (tokens.others, differ)):
        if asked.any():
            yield kinds, places[asked], window_hashes(tokens, kinds, width)[asked]


def item_windows(items: DataFrame, window: int = WINDOW, least_fixed: int = LEAST_FIXED) -> DataFrame:
    """(item_id, width, exact, h): the windows of the items, repeated ones once an item."""
    memo = Memo(_packed)

    def rows(part: dict[str, list]) -> Iterator[tuple]:
        for item_id, text in zip(part["item_id"], part["text"]):
            tokens = next(groups([text], memo))[1]
            width = min(window, len(tokens.of))
            if item_id is None or not width:
                continue
            for kinds, places, hashes in readings(tokens, width):
                for at, h in zip(places.tolist(), hashes.tolist()):
                    if kinds is None or (kinds[at:at + width] == WORD).sum() >= min(least_fixed, width):
                        yield item_id, width, kinds is None, h

    schema = "item_id long, width int, exact boolean, h long"
    return map_rows(items.select("item_id", "text"), schema, rows).distinct()


def document_windows(texts: DataFrame, widths: list[int]) -> DataFrame:
    """(a, b, at, h): the place and hash of every window of the texts (a, b, text)."""
    memo = Memo(_packed)

    def rows(part: dict[str, list]) -> Iterator[tuple]:
        for start, tokens in groups(part["text"], memo):
            begins = np.searchsorted(tokens.of, np.arange(tokens.of[-1] + 1 if len(tokens.of) else 0))
            for width in widths:
                for _, places, hashes in readings(tokens, width):
                    # Runs of windows side by side in a text, of at most CHUNK.
                    of = tokens.of[places]
                    cuts = np.flatnonzero((np.diff(places) != 1) | (np.diff(of) != 0)) + 1
                    for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(places)]):
                        row = int(of[low])
                        for at in range(low, high, CHUNK):
                            yield (part["a"][start + row], part["b"][start + row], int(places[at] - begins[row]),
                                   hashes[at:min(high, at + CHUNK)])

    cut = map_rows(texts.select("a", "b", "text"), "a long, b long, start long, hashes array<long>", rows)
    return (cut.select("a", "b", "start", F.posexplode("hashes").alias("i", "h"))
            .select("a", "b", (F.col("start") + F.col("i")).alias("at"), "h"))


def _name() -> list[Column]:
    """128 bits of hashes that name a text."""
    return [F.xxhash64("text").alias("a"), F.xxhash64(F.lit("text"), "text").alias("b")]


def matches(docs: DataFrame, items: DataFrame, window: int = WINDOW,
            least_fixed: int = LEAST_FIXED) -> DataFrame:
    """(a, b, found), stored: the items that texts share windows with, by the texts' names.

    The planner sends the table of item windows to the tasks while its size is below its
    limit, so that few rows of documents are shuffled, and shuffles both sides beyond.
    """
    known = materialize(item_windows(items, window, least_fixed), "item_windows")
    widths = sorted(r.width for r in known.select("width").distinct().collect())  # ``window`` at most
    met = document_windows(docs.select(*_name(), "text"), widths).join(known, "h")
    held = met.groupBy("a", "b", "item_id", "width", "at").agg(F.max("exact").alias("same"))
    hits = held.groupBy("a", "b", "item_id").agg(
        F.count(F.lit(1)).alias("hits"), F.count_if(~F.col("same")).alias("changed"))
    found = hits.groupBy("a", "b").agg(
        F.sort_array(F.collect_list(F.struct("item_id", "hits", "changed"))).alias("found"))
    return materialize(found, "matched", replaces=[known])


def annotate(docs: DataFrame, items: DataFrame, window: int = WINDOW,
             least_fixed: int = LEAST_FIXED, carry_text: bool = True) -> DataFrame:
    """``docs`` with ``matches``, the items each text shares windows with.

    ``hits`` counts windows of the text found in the item, ``changed`` those with other
    slot values. Null and empty texts match nothing; nor does an empty benchmark or an
    item without an id. Very long texts are whole, in rows of ``CHUNK`` windows. Rows that
    repeat a text have the same matches. A column named matches is replaced, all others
    stay as they are, whatever their names; ``carry_text=False`` leaves the text out.
    """
    names = [c for c in docs.columns if c != "matches" and (carry_text or c != "text")]
    found = matches(docs, items, window, least_fixed)
    none = F.array().cast("array<struct<item_id:bigint,hits:bigint,changed:bigint>>")
    carried = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), *_name())
    return carried.join(found, ["a", "b"], "left").select(
        *[F.col("row").getField(c).alias(c) for c in names], F.coalesce("found", none).alias("matches"))


def report(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """(doc_id, contaminated, n_items, n_hits, n_changed, items) of each row of ``docs``.

    ``items`` lists the matched item ids in order, comma-joined.
    """
    marked = annotate(docs.select("doc_id", "text"), items, carry_text=False, **options)

    def total(name: str):
        return F.aggregate("matches", F.lit(0).cast("bigint"), lambda n, x: n + x[name])

    ids = F.sort_array(F.transform("matches", lambda x: x["item_id"]))
    return marked.select(
        "doc_id", (F.size("matches") > 0).alias("contaminated"),
        F.size("matches").cast("bigint").alias("n_items"), total("hits").alias("n_hits"),
        total("changed").alias("n_changed"),
        F.array_join(ids.cast("array<string>"), ",").alias("items"))
