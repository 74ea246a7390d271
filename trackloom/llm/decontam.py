"""Benchmark decontamination by canonical templates, in built-in expressions only.

Numbers, names (capitalised words inside a sentence) and units after numbers become typed
placeholders. Windows of template words of the documents are hash-joined with those of the
benchmark. Along a diagonal of matches (the same offset between document and item) every value of
the item must stand for one value of the document; windows that disagree with the commonest value
are dropped. A document that still holds enough of an item's windows leaks it, whatever numbers,
names and units it was given.

Defined results: null, empty and short texts match nothing; items without a window of at least
``LEAST_WORDS`` literal words carry no evidence and are never reported; repeated rows of a
document are reported once; ties between values go to the smallest.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

WINDOW = 5
#: share of an item's windows that a document must hold consistently
COVERAGE = 0.5
LEAST_WORDS = 2
#: up to so many benchmark windows (about 32 bytes each) or matched documents are broadcast
BROADCAST_ROWS = 500_000

NAME, NUMBER, UNIT = "\u0001", "\u0002", "\u0003"
#: units of measurement, money and time that can follow a number (fixed values)
UNITS = (
    "kg g mg t lb lbs oz km m cm mm mi ft in yd l ml gal s sec min h hr hrs ms kb mb gb tb w kw v a hz "
    "gram grams kilogram kilograms ton tons pound pounds ounce ounces meter meters metre metres "
    "kilometer kilometers kilometre kilometres mile miles foot feet inch inches yard yards liter liters "
    "litre litres second seconds minute minutes hour hours day days week weeks month months year years "
    "dollar dollars euro euros cent cents percent degree degrees"
).split()


def valued(text: Column) -> Column:
    """Lower-case words; a placeholder's sign is followed by the value it stands for."""
    names = F.regexp_replace(text, r"\p{Lu}(?<=[\p{Ll}\p{Nd},;]\s.)\p{Ll}[\p{L}\p{M}]*", f"{NAME}$0")
    numbers = F.regexp_replace(names, r"[0-9]+(?:[.,:/-][0-9]+)*", f" {NUMBER}$0 ")
    units = F.regexp_replace(numbers, f"(?i)(?<=[0-9]\\s{{1,3}})(?:{'|'.join(UNITS)})(?![\\p{{L}}\\p{{M}}])", f"{UNIT}$0")
    return F.lower(units)


def words(text: Column) -> Column:
    """Runs of letters and digits; a placeholder's value is one word, with the separators inside it."""
    value = r"[\u0001-\u0003](?:[\p{L}\p{M}\p{Nd}.,:/-]*[\p{L}\p{M}\p{Nd}])?"
    return F.regexp_extract_all(valued(text), F.lit(rf"{value}|[\p{{L}}\p{{M}}\p{{Nd}}\u0001-\u0003]+"), 0)


def template(text: Column) -> Column:
    """The words, of a value its placeholder's sign only: each word keeps its position."""
    sign = lambda w: F.substring(w, 1, 1)
    return F.transform(words(text), lambda w: F.when(sign(w).isin(NAME, NUMBER, UNIT), sign(w)).otherwise(w))


def _windows(words: Column, size: int) -> Column:
    """Hash of every window of ``size`` words, in order; none for shorter texts."""
    starts = F.when(F.size(words) >= size, F.sequence(F.lit(1), F.size(words) - (size - 1))).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, size)))


def item_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(item, bench_at, size, window, raw) of the windows that carry evidence.

    An item shorter than a window is one window of its own size.
    """
    items = benchmark.select(F.col(item).alias("item"), F.col(text).alias("t")).distinct()
    split = items.select("item", template(F.col("t")).alias("words"), words(F.col("t")).alias("raw"))
    sized = split.withColumn("size", F.least(F.lit(window), F.size("words"))).where("size > 0")
    found = sized.select(
        "item",
        "size",
        "words",
        "raw",
        F.explode(F.sequence(F.lit(1), F.size("words") - F.col("size") + 1)).alias("bench_at"),
    )
    own = F.slice("words", F.col("bench_at"), F.col("size"))
    literal = F.size(F.filter(own, lambda w: ~w.isin(NAME, NUMBER, UNIT)))
    return found.where(literal >= LEAST_WORDS).select(
        "item", "bench_at", "size", F.xxhash64(own).alias("window"), F.slice("raw", F.col("bench_at"), F.col("size")).alias("raw")
    )


def matches(docs: DataFrame, items: DataFrame, doc: str, text: str, window: int) -> DataFrame:
    """(doc, text_hash, at, size, window) of the windows of documents that an item has as well."""
    known = items.select("size", "window").distinct()
    small = known.count() <= BROADCAST_ROWS
    sizes = sorted(r[0] for r in items.select("size").distinct().limit(window).collect())
    split = docs.select(
        F.col(doc).alias("doc"), F.xxhash64(F.col(text)).alias("text_hash"), template(F.col(text)).alias("words")
    )
    out = None
    for size in sizes:
        keys = known.where(F.col("size") == size).select("window")
        own = split.select("doc", "text_hash", F.posexplode(_windows(F.col("words"), size)).alias("at", "window"))
        part = own.join(F.broadcast(keys) if small else keys, "window", "left_semi").withColumn("size", F.lit(size))
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = split.select("doc", "text_hash", F.lit(0).alias("at"), F.lit(0).alias("size"), F.lit(0).cast("long").alias("window")).where("false")
    return out.withColumn("at", F.col("at") + 1)


def leaking_texts(
    docs: DataFrame,
    benchmark: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    coverage: float = COVERAGE,
) -> DataFrame:
    """(doc, text_hash, item, matched, changed, windows) of each text and item that it leaks."""
    items = stored(item_windows(benchmark, item, item_text, window), "items")
    hits = stored(matches(docs, items, doc, text, window), "hits")
    # documents that could reach the coverage of an item at all, before values are looked at
    totals = items.groupBy("item").agg(F.count("*").alias("windows"))
    pairs = hits.join(items.select("item", "bench_at", "size", "window"), ["size", "window"])
    held = pairs.groupBy("doc", "text_hash", "item").agg(F.countDistinct("bench_at").alias("held"))
    likely = stored(
        held.join(totals, "item").where(F.col("held") >= coverage * F.col("windows")).drop("held", "windows"), "likely"
    )
    whole = likely.select(F.col("doc").alias("d"), F.col("text_hash").alias("h")).distinct()
    whole = F.broadcast(whole) if whole.count() <= BROADCAST_ROWS else whole
    own = docs.select(F.col(doc).alias("doc"), F.col(text).alias("t"), F.xxhash64(F.col(text)).alias("text_hash"))
    read = (
        own.join(whole, F.col("doc").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")), "left_semi")
        .dropDuplicates(["doc", "text_hash"])
        .select(F.col("doc").alias("d"), F.col("text_hash").alias("h"), words(F.col("t")).alias("own"))
    )
    same = F.col("doc").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h"))
    aligned = pairs.join(
        likely.select(F.col("doc").alias("d"), F.col("text_hash").alias("h"), F.col("item").alias("i")),
        same & (F.col("item") == F.col("i")),
        "left_semi",
    )
    aligned = aligned.join(items.select("item", "bench_at", "raw"), ["item", "bench_at"])
    aligned = aligned.join(read, same).select(
        "doc",
        "text_hash",
        "item",
        (F.col("at") - F.col("bench_at")).alias("offset"),
        "bench_at",
        F.arrays_zip(F.col("raw").alias("theirs"), F.slice("own", F.col("at"), F.col("size")).alias("ours")).alias("slots"),
    )
    aligned = stored(
        aligned.withColumn(
            "slots",
            F.filter("slots", lambda s: F.substring(s["theirs"], 1, 1).isin(NAME, NUMBER, UNIT)),
        ),
        "aligned",
    )
    place = ["doc", "text_hash", "item", "offset"]
    votes = (
        aligned.select(*place, F.explode("slots").alias("s"))
        .groupBy(*place, F.col("s.theirs").alias("theirs"), F.col("s.ours").alias("ours"))
        .count()
    )
    chosen = votes.groupBy(*place, "theirs").agg(F.min(F.struct(-F.col("count"), F.col("ours"))).alias("best"))
    chosen = chosen.select(*place, "theirs", F.col("best.ours").alias("chosen"))
    at = [*place, "bench_at"]
    slots = aligned.select(*at, F.explode("slots").alias("s")).select(
        *at, F.col("s.theirs").alias("theirs"), F.col("s.ours").alias("ours")
    )
    agree = [slots[c].eqNullSafe(chosen[c]) for c in (*place, "theirs")]
    judged = slots.join(chosen, agree).select(
        *[slots[c] for c in at],
        (slots["ours"] != chosen["chosen"]).cast("int").alias("odd"),
        (slots["ours"] != slots["theirs"]).cast("int").alias("changed"),
    )
    plain = aligned.where(F.size("slots") == 0).select(*at, F.lit(0).alias("odd"), F.lit(0).alias("changed"))
    windows = judged.unionByName(plain).groupBy(*at).agg(F.max("odd").alias("odd"), F.max("changed").alias("changed"))
    kept = windows.where("odd = 0").groupBy("doc", "item", "text_hash").agg(
        F.countDistinct("bench_at").alias("matched"), F.max("changed").alias("changed")
    )
    return kept.join(totals, "item").where(F.col("matched") >= coverage * F.col("windows"))


def leaks(docs: DataFrame, benchmark: DataFrame, doc: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """One row per document id and item it leaks: windows held, share of the item, changed values."""
    enough = leaking_texts(docs, benchmark, doc, text, **how)
    return enough.groupBy(F.col("doc").alias("doc_id"), F.col("item").alias("item_id")).agg(
        F.max("matched").alias("matched"),
        F.max("windows").alias("windows"),
        F.max("changed").cast("boolean").alias("reparameterised"),
    )


def without_leaks(
    docs: DataFrame, benchmark: DataFrame, doc: str = "doc_id", text: str = "text", by_text: bool = False, **how
) -> DataFrame:
    """``docs`` without those that leak an item.

    Rows that share an id, and rows without id, are judged together, or with ``by_text`` each by
    its own text.
    """
    found = leaking_texts(docs, benchmark, doc, text, **how)
    found = found.select(F.col("doc").alias("__leaked"), F.col("text_hash").alias("__hash"))
    same = docs[doc].eqNullSafe(F.col("__leaked"))
    if not by_text:
        return docs.join(found.select("__leaked").distinct(), same, "left_anti")
    return docs.join(found.distinct(), same & (F.xxhash64(docs[text]) == F.col("__hash")), "left_anti")
