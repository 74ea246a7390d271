"""Line deduplication by log templates, in built-in expressions only.

A line is parsed by a tree of fixed depth: its number of words, then its leading words, where a
word with a digit is a variable field ``<*>``. Below, its words are cut into blocks of a fifth of
them at most (one word up to nine words, two up to fourteen, ...), and each block in turn is left out,
as a field; a block among the leading words makes a wildcard of that step of the tree. Two different
lines that are equal but for one block meet under the same key and are linked, and lines that links
connect have one template: an edited line and its original, and also lines whose fields lie in
several places, as long as the lines between them occur. Lines of less than five words have no
field but their digits, and lines of less than ``min_tokens`` words none at all. A template that
occurs in several documents is kept in the first of them (smallest id) and dropped from the rest.

Defined results: null texts stay null and empty texts empty; lines without words are never dropped;
lines repeated inside one document only are left alone; rows of one id are one document for each
text, ordered by the id (none last), then by the text's hash; repeated rows get the same text; an
empty table gives no row; lines of any length are parsed whole. Lines and keys are compared by 64-bit
hashes.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, stored
from .components import components

MIN_TOKENS = 4
MIN_DOCS = 2
#: steps of the tree below the number of words
DEPTH = 3
#: the share of a line's words that equal those of a line with its template, but for a field
SIMILARITY = 0.8
#: up to so many keys or templates (at most 40 bytes each) are broadcast; beyond, a shuffle join
BROADCAST_LEAVES = 500_000
SALTS = 32
#: a word with a digit, matched from its beginning only
_FIELD = r"(?<!\S)[^\s0-9]*+[0-9]\S*"


def _words(line: Column, min_tokens: int) -> Column:
    """The words of a line; those with a digit are fields, if there are enough words."""
    own = F.array_remove(F.split(line, r"\s+"), "")
    masked = F.array_remove(F.split(F.regexp_replace(line, _FIELD, "<*>"), r"\s+"), "")
    return F.when(line.rlike("[0-9]"), F.when(F.size(masked) < min_tokens, own).otherwise(masked)).otherwise(own)


def _keys(words: Column, depth: int, similarity: float) -> Column:
    """A key for each block that is left out: number of words, way through the tree, the rest."""
    n = F.size(words)
    block = F.floor(n * F.lit(1 - similarity) + F.lit(1e-9)).cast("int")

    def key(j: Column) -> Column:
        before = F.slice(words, F.lit(1), j * block)
        behind = F.slice(words, (j + 1) * block + 1, n)
        way = F.slice(F.concat(before, F.array_repeat(F.lit("<*>"), F.least(block, n - j * block)), behind), 1, depth)
        return F.xxhash64(n, j, way, before, behind)

    return F.when(block > 0, F.transform(F.sequence(F.lit(0), F.ceil(n / block).cast("int") - 1), key)).otherwise(
        F.array().cast("array<bigint>")
    )


def parsed(docs: DataFrame, doc: str, text: str, min_tokens: int, depth: int, similarity: float) -> DataFrame:
    """(doc, text_hash, line_no, line_hash, keys) of every line with a word.

    A document's lines are parsed by one expression, so nothing is split twice.
    """
    tokens = F.transform(F.split(F.col(text), "\n"), lambda line: _words(line, min_tokens))
    lines = F.transform(
        tokens,
        lambda words, i: F.struct(
            i.alias("line_no"), F.size(words).alias("n"), F.xxhash64(words).alias("line_hash"),
            _keys(words, depth, similarity).alias("keys"),
        ),
    )
    return (
        docs.select(F.col(doc).cast("long").alias("doc"), F.xxhash64(F.col(text)).alias("text_hash"), F.inline(lines))
        .where("n > 0")
        .drop("n")
    )


def templates(known: DataFrame) -> DataFrame:
    """(line_hash, template) of the lines that are linked to another one."""
    met = known.select("line_hash", F.explode("keys").alias("key"))
    shared = met.groupBy("key").agg(F.min("line_hash").alias("hub"), F.max("line_hash").alias("other"))
    shared = stored(shared.where("hub <> other").drop("other"), "shared-keys")
    near = F.broadcast(shared) if shared.count() <= BROADCAST_LEAVES else shared
    links = met.join(near, "key").where("line_hash <> hub").select(F.col("line_hash").alias("u"), F.col("hub").alias("v"))
    return components(links, "line-links").select(F.col("node").alias("line_hash"), F.col("component").alias("template"))


def repeated_lines(
    docs: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    min_tokens: int = MIN_TOKENS,
    min_docs: int = MIN_DOCS,
    depth: int = DEPTH,
    similarity: float = SIMILARITY,
) -> DataFrame:
    """(doc, text_hash, drops): the numbers of the lines to drop, for documents that have some."""
    known = stored(parsed(docs, doc, text, min_tokens, depth, similarity), "lines")
    found = stored(templates(known), "templates")
    few = found.count() <= BROADCAST_LEAVES
    place = F.struct(F.coalesce("doc", F.lit(2**63 - 1)).alias("id"), F.col("text_hash").alias("hash"))
    placed = known.drop("keys").join(F.broadcast(found) if few else found, "line_hash", "left").select(
        F.coalesce("template", "line_hash").alias("template"), place.alias("doc_order"), "doc", "text_hash", "line_no"
    )
    if not few:
        placed = stored(placed, "placed")
    ends = placed.groupBy("template").agg(F.min("doc_order").alias("first_doc"), F.max("doc_order").alias("last_doc"))
    recurring = ends.where("first_doc <> last_doc").drop("last_doc")
    if min_docs > 2:
        counted = placed.select("template", "doc_order").distinct().groupBy("template").count()
        recurring = recurring.join(counted.where(F.col("count") >= min_docs).select("template"), "template")
    recurring = stored(recurring, "recurring")
    if recurring.count() <= BROADCAST_LEAVES:
        marked = placed.join(F.broadcast(recurring), "template")
    else:
        # a template can hold a third of all lines: its lines are spread over copies of its row
        salt = F.pmod(F.xxhash64("doc_order", "line_no"), F.lit(SALTS)).cast("int")
        copies = recurring.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        marked = placed.withColumn("salt", salt).join(copies, ["template", "salt"])
    return marked.where("doc_order <> first_doc").groupBy("doc", "text_hash").agg(F.collect_set("line_no").alias("drops"))


def dedup_lines(docs: DataFrame, doc: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``docs`` with recurring lines taken out of ``text``, and the numbers of both.

    Adds ``lines`` and ``dropped_lines`` (renamed if ``docs`` has such columns); all rows and all
    other columns stay as they are.
    """
    n_lines, n_dropped = fresh(docs, "lines"), fresh(docs, "dropped_lines")
    d, h, drops, own, key = (fresh(docs, f"own_{n}") for n in ("doc", "hash", "drops", "lines", "text_hash"))
    found = repeated_lines(docs, doc, text, **how).select(
        F.col("doc").alias(d), F.col("text_hash").alias(h), F.col("drops").alias(drops)
    )
    others = [F.col(c) for c in docs.columns if c != text]
    cut = docs.select(*others, F.split(F.col(text), "\n").alias(own), F.xxhash64(F.col(text)).alias(key))
    joined = cut.join(found, cut[doc].cast("long").eqNullSafe(F.col(d)) & (F.col(key) == F.col(h)), "left")
    size = F.when(F.col(own).isNull(), 0).otherwise(F.size(own))
    numbers = F.array_except(F.sequence(F.lit(0), F.size(own) - 1), drops)
    left = F.transform(numbers, lambda i: F.get(own, i))
    out = joined.withColumns(
        {
            n_lines: size.cast("long"),
            n_dropped: F.when(F.col(drops).isNull(), 0).otherwise(F.size(drops)).cast("long"),
            text: F.array_join(F.when(F.col(drops).isNull(), F.col(own)).otherwise(left), "\n"),
        }
    )
    return out.select(*docs.columns, n_lines, n_dropped)
