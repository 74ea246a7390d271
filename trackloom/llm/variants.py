"""Spelling variants: words that differ by one code point, grouped below the most frequent one.

Two words are near if one code point inserted, deleted or replaced turns one into the other. A
word's form is its most frequent near word (ties: the first in code-point order) if that one occurs
at least ``ratio`` times as often; the root is where the forms lead.

Method: a frontier moves through a trie that is a table. A node is a prefix of words; a state (word,
node, position, edits) says that the word's code points up to the position can be turned into the
node with so many edits. The unedited states are the words' own prefixes. Each meets the children of
its node and takes its one edit there: a child by another, greater code point (a replacement), or the
node itself (a deletion). Then, level by level, the edited states are joined with the trie's edges by
node and next code point, and go on to the child. States that have read their word and stand on a
word are the near pairs. Each unordered pair is met from one side only: words of one length from the
smaller, others from the longer; a repeated code point is deleted at its first place only, so no state
comes twice. A node knows which lengths remain below it and, in 256 bits, which endings; a state whose
ending is not among them can lead nowhere and is not written. The bits only ever spare work.

Size: a word has as many unedited states as code points, and few edited ones. All words begin at the
root; a node with more than ``NODE_WORDS`` words below it is copied and states choose a copy by a hash
of their word. Words of more than ``LEVELS`` code points, for which each code point would be a round,
are met by deletion keys instead: equal rests without the code point at the same place, or without one
against whole. A key has at most as many words as there are code points to replace, so no group
is large, and the comparison is as exact as the trie's.

Defined results: null, empty and letterless texts have no words; a row without id gives its runs
undamaged; repeated rows count each; a word without near words has no form and is its own root; an
empty table gives no row; extra columns are not read.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..workspace import scratch_path
from .common import small_side, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEVELS = 60
NODE_WORDS = 4_096
#: up to so many crowded nodes (under 100 bytes each) are broadcast; beyond, a shuffle join
BROADCAST_NODES = 100_000
_PAIRS = "a string, b string"


def lowered_runs(text: Column) -> Column:
    """Maximal runs of Latin letters as an array; only A-Z are lower-cased."""
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit("([a-zÀ-ÿ]+)"), F.lit(1))


def word_counts(words: DataFrame, least_length: int, least_count: int) -> DataFrame:
    """``word, n`` of a column ``word``, for words long and frequent enough."""
    long = words.where(F.length("word") >= least_length)
    return long.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def _ending(rest: str) -> str:
    """SQL: which of 256 bits stands for an ending."""
    return f"cast(pmod(xxhash64({rest}), 256) as int)"


def trie(words: DataFrame) -> DataFrame:
    """A row per node: node, depth, below (words), lens, ends.

    Bit r of ``lens`` says that some word ends r code points below, so bit 0 that the node is a word;
    ``ends`` are four longs whose bits stand for the endings of the words below.
    """
    steps = words.select("word", F.explode(F.sequence(F.lit(0), F.length("word"))).alias("depth")).selectExpr(
        "left(word, depth) as node", "depth", "shiftleft(1L, length(word) - depth) as lens",
        f"{_ending('substring(word, depth + 1)')} as bit",
    )
    parts = [F.bit_or(F.expr(f"if(bit div 64 = {k}, shiftleft(1L, bit % 64), 0L)")) for k in range(4)]
    return steps.groupBy("node", "depth").agg(
        F.count(F.lit(1)).alias("below"), F.bit_or("lens").alias("lens"), F.array(*parts).alias("ends")
    )


#: whether a word ends below {n} as the rest does: ``remain`` code points, bit ``bit``
_LEADS_ON = "shiftright({n}.lens, remain) & 1 = 1 and shiftright({n}.ends[bit div 64], bit % 64) & 1 = 1"


def first_edits(words: DataFrame, nodes: DataFrame) -> DataFrame:
    """(word, node, level): every word after its one edit, having read ``level`` code points."""
    copies = F.ceil(F.col("below") / NODE_WORDS).cast("int")
    crowded = stored(nodes.where(F.col("below") > NODE_WORDS).select("node", copies.alias("copies")), "crowded-nodes")
    own = F.struct("ch", "lens", "ends").alias("kid")
    # the node itself stands among its children as the one without a code point
    kids = nodes.select("node", F.lit("").alias("ch"), "lens", "ends").unionByName(
        nodes.where("depth > 0").selectExpr("left(node, depth - 1) as node", "right(node, 1) as ch", "lens", "ends")
    )
    kids = kids.groupBy("node").agg(F.collect_list(own).alias("kids"))
    kids = kids.join(small_side(crowded, BROADCAST_NODES), "node", "left").select(
        "node", "kids", F.explode(F.sequence(F.lit(0), F.coalesce("copies", F.lit(1)) - 1)).alias("copy")
    )
    states = words.select("word", F.explode(F.sequence(F.lit(1), F.length("word"))).alias("level"))
    states = states.withColumn("node", F.expr("left(word, level - 1)")).join(
        small_side(crowded, BROADCAST_NODES), "node", "left"
    )
    states = states.withColumn("copy", F.pmod(F.xxhash64("word"), F.coalesce("copies", F.lit(1))).cast("int"))
    met = states.join(kids, ["node", "copy"]).selectExpr(
        "word", "level", "node", "kids", "substring(word, level, 1) as c",
        "if(level > 1, substring(word, level - 1, 1), '') as before",
        "length(word) - level as remain", f"{_ending('substring(word, level + 1)')} as bit",
    )
    moves = f"""filter(kids, k -> (k.ch > c or k.ch = '' and c != before) and {_LEADS_ON.format(n='k')})"""
    return met.select("word", F.explode(F.expr(f"transform({moves}, k -> concat(node, k.ch))")).alias("node"), "level")


def trie_pairs(words: DataFrame) -> DataFrame:
    """Near pairs (a, b), each once, of a column ``word`` of different words of at most 60 code points."""
    spark = words.sparkSession
    longest = words.agg(F.max(F.length("word"))).first()[0]
    if longest is None:
        return spark.createDataFrame([], _PAIRS)
    nodes_path, first_path, moved_path = (scratch_path(spark, n) for n in ("trie-nodes", "trie-edits", "trie-states"))
    made = trie(words)
    made.write.partitionBy("depth").parquet(nodes_path)
    nodes = spark.read.schema(made.schema).parquet(nodes_path)
    begun = first_edits(words, nodes)
    begun.write.partitionBy("level").parquet(first_path)
    begun = spark.read.schema(begun.schema).parquet(first_path)
    states = begun.where("level = 1").drop("level")
    for level in range(1, longest):
        ahead = states.where(F.length("word") > level).selectExpr(
            "word", f"concat(node, substring(word, {level + 1}, 1)) as node",
            f"length(word) - {level + 1} as remain", f"{_ending(f'substring(word, {level + 2})')} as bit",
        )
        # a word with a deletion stands one code point higher in the trie
        edges = nodes.where(F.col("depth").isin(level, level + 1)).select("node", F.struct("lens", "ends").alias("to"))
        moved = ahead.join(edges, "node").where(_LEADS_ON.format(n="to")).select("word", "node")
        moved.write.parquet(f"{moved_path}/level={level + 1}")
        moved = spark.read.schema(moved.schema).parquet(f"{moved_path}/level={level + 1}")
        states = moved.unionByName(begun.where(F.col("level") == level + 1).drop("level"))
    ends = begun if longest == 1 else begun.unionByName(spark.read.schema(begun.schema).parquet(moved_path))
    return ends.where(F.length("word") == F.col("level")).select(F.col("word").alias("a"), F.col("node").alias("b"))


def long_pairs(words: DataFrame) -> DataFrame:
    """Near pairs (a, b), each once, by deletion keys; for words with too many levels."""
    rests = words.select("word", F.explode(F.sequence(F.lit(1), F.length("word"))).alias("at")).withColumn(
        "rest", F.expr("concat(left(word, at - 1), substring(word, at + 1))")
    )
    key = F.sha2(F.concat_ws(":", "at", "rest"), 256)
    replaced = rests.select("word", key.alias("key"))
    other = replaced.withColumnRenamed("word", "b")
    same = replaced.join(other, "key").where(F.col("word") < F.col("b")).select(F.col("word").alias("a"), "b")
    whole = words.select(F.col("word").alias("b"))
    shorter = rests.join(whole, F.col("rest") == F.col("b")).select(F.col("word").alias("a"), "b")
    return same.unionByName(shorter).distinct()


def near_pairs(words: DataFrame) -> DataFrame:
    """All near pairs (a, b) of a column ``word`` of different words, each once."""
    length = F.length("word")
    short, long = (words.select("word").where(c) for c in (length <= LEVELS, length >= LEVELS))
    # words of exactly LEVELS code points are in both parts
    return trie_pairs(short).unionByName(
        long_pairs(long).where((F.length("a") > LEVELS) | (F.length("b") > LEVELS))
    )


def variants(words: DataFrame, ratio: float = 2) -> DataFrame:
    """word, n, n_near, form, form_n, root of a stored table of different words and their counts."""
    pairs = stored(near_pairs(words), "near-pairs")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    other = words.select(F.col("word").alias("b"), F.col("n").alias("near_n"))
    best = both.join(other, "b").groupBy("a").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "b")).alias("best")
    )
    is_form = -F.col("best.less") >= ratio * F.col("n")
    found = stored(
        words.join(best.withColumnRenamed("a", "word"), "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("best.b")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    return found.join(_roots(found, ratio), "word", "left").withColumn("root", F.coalesce("root", "word"))


def _roots(found: DataFrame, ratio: float) -> DataFrame:
    """word, root of all words with a form.

    Counts grow by ``ratio`` from a word to its form, so the longest way is known from the counts'
    range; each round doubles the way that is covered.
    """
    ends = found.agg(F.min("n").alias("least"), F.max("n").alias("most")).first()
    way = math.log(ends.most / ends.least, ratio) + 1 if ends.most else 1
    roots = found.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(max(way, 1))) if way > 1 else 0):
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = stored(
            roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots"
        )
    return roots
