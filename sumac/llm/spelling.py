"""Groups of spelling variants: words one edit apart, found by walking a trie held in tables."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from sumac.session import freeze, scratch_path

#: A trie node over at most this many words is a leaf; its words are compared with each other.
LEAF = 32
#: The nodes of one level are broadcast up to this many (checked by counting); more are joined by a shuffle.
BROADCAST_NODES = 100_000
#: Levels walked before the frontier is written.
LEVELS = 3
#: Ends every word, so that no word is the beginning of another; it sorts before all letters.
END = "\n"
#: Longs with a bit for each of 256 hash values of what follows a node in its words.
BITS = ("m0", "m1", "m2", "m3")


def corpus_words(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = 7, fewest: int = 2, slip: int = 31
) -> DataFrame:
    """(word, n): the words of all texts with at least ``shortest`` code points and ``fewest`` occurrences.

    Words are maximal runs of Latin letters up to U+00FF with A-Z in lower case. With h the crc32 of "id:run", a run whose h is divisible
    by ``slip`` loses its code point h % length. A null text has no words, rows without an id are left out, repeated rows count each.
    """
    found = F.regexp_extract_all(text_col, F.lit(f"[A-Za-zÀ-ÿ]{{{shortest},}}"), F.lit(0))
    runs = docs.select(F.col(id_col).cast("long").alias("doc"), F.explode(found).alias("run")).filter("doc is not null")
    runs = runs.select("doc", F.translate("run", string.ascii_uppercase, string.ascii_lowercase).alias("run"))
    runs = runs.withColumn("h", F.crc32(F.concat_ws(":", F.col("doc").cast("string"), "run").cast("binary")))
    runs = runs.withColumn("k", (F.col("h") % F.char_length("run")).cast("int"))
    word = F.when(F.col("h") % slip == 0, F.expr("concat(left(run, k), substring(run, k + 2))")).otherwise(F.col("run"))
    counted = runs.select(word.alias("word")).filter(F.char_length("word") >= shortest).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= fewest)


def _from(text: str, at: Column) -> Column:
    """What follows the first ``at`` code points."""
    return F.substring(F.col(text), at + 1, F.lit(1 << 30))


def _admits(rest: Column) -> Column:
    """Whether a node's bits hold the hash of ``rest``; false only if no word under the node goes on like that."""
    h = F.xxhash64(rest)
    bits = F.element_at(F.array(*BITS), (h.bitwiseAND(F.lit(192)) / 64 + 1).cast("int"))
    return F.getbit(bits, h.bitwiseAND(F.lit(63)).cast("int")) == 1


def _nodes(own: DataFrame, depth: int) -> DataFrame:
    """The children of the inner nodes of a level, whose words ``own`` has: (child, leaf, and the ``BITS``)."""
    each = own.select(F.substring("s", 1, depth + 1).alias("child"), F.xxhash64(_from("s", F.lit(depth + 1))).alias("h"))
    bits = [F.expr(f"bit_or(if(((h >> 6) & 3) = {k}, shiftleft(1L, cast(h & 63 as int)), 0L))").alias(b) for k, b in enumerate(BITS)]
    return each.groupBy("child").agg((F.count(F.lit(1)) <= LEAF).alias("leaf"), *bits)


def near_words(words: DataFrame) -> DataFrame:
    """(a, b), a < b in no fixed order of length: all pairs of ``word`` that differ by exactly one inserted, deleted or replaced code point.

    The trie is a table of edges per level; nodes are named by their prefix and split while they hold more than ``LEAF`` words.
    The frontier holds states (word, position, node) that have spent their edit. On each level they follow the edge of their next
    letter, and every word whose own path is still inside the trie adds states: without its next letter, and along all edges of a
    larger letter. A pair is found from its longer word or from the one with the smaller letter, so both directions are covered.
    A state that reaches a leaf names its target, which must be a word. Words of one leaf are compared directly, at most ``LEAF``.

    Null words are left out, repeated ones count once. Levels go on as deep as more than ``LEAF`` words share a prefix, whatever the length of words.
    """
    spark = words.sparkSession
    words = freeze(words.select("word").filter("word is not null").distinct(), "words")
    base, ends = scratch_path(spark, "frontier"), scratch_path(spark, "leaves")
    held = own = words.select(F.concat("word", F.lit(END)).alias("s"))
    states = own.limit(0).select("s", F.lit(0).alias("p"), F.col("s").alias("node"), F.lit(False).alias("leaf"))
    pending, depth = 0, 0
    while True:
        nodes = freeze(_nodes(own, depth), "nodes")
        size = nodes.count()
        if not size:
            break
        small = size <= BROADCAST_NODES
        edges = F.broadcast(nodes) if small else nodes
        if not small or pending >= LEVELS:
            states, pending = _written(states, base, depth), 0
        letter, before = F.substring("s", depth + 1, 1), F.substring("s", depth, 1) if depth else F.lit("")
        inner = own.filter(letter != END)
        dropped = inner.filter(letter != before).select("s", F.lit(depth + 1).alias("p"), F.substring("s", 1, depth).alias("node"), F.lit(False).alias("leaf"))
        walking = states.unionByName(dropped).withColumn("child", F.when(~F.col("leaf"), F.concat("node", F.substring(F.col("s"), F.col("p") + 1, F.lit(1)))))
        walked = walking.withColumnRenamed("leaf", "done").join(edges, "child", "left" if small else "inner")
        alive = F.col("done") | F.coalesce(_admits(_from("s", F.col("p") + 1)), F.lit(False))
        walked = walked.filter(alive).select(
            "s",
            F.when(F.col("done"), F.col("p")).otherwise(F.col("p") + 1).alias("p"),
            F.coalesce("child", "node").alias("node"),
            (F.col("done") | F.col("leaf")).alias("leaf"),
        )
        branches = edges.withColumn("parent", F.substring("child", 1, depth))
        replaced = inner.withColumn("parent", F.substring("s", 1, depth)).join(branches, "parent")
        replaced = replaced.filter((F.substring("child", depth + 1, 1) > letter) & _admits(_from("s", F.lit(depth + 1))))
        states = walked.unionByName(replaced.select("s", F.lit(depth + 1).alias("p"), F.col("child").alias("node"), "leaf"))
        placed = held.withColumn("child", F.substring("s", 1, depth + 1)).join(edges.select("child", "leaf"), "child")
        if not small:
            placed = freeze(placed, "placed")
        placed.filter("leaf").select("child", F.expr("left(s, char_length(s) - 1)").alias("s")).write.parquet(f"{ends}/level={depth}")
        own = placed.filter("not leaf").select("s")
        held, pending, depth = held if small else own, pending + 1, depth + 1
    if not depth:
        return spark.createDataFrame([], "a string, b string")
    _written(states, base, depth)
    reached = spark.read.parquet(base).filter("leaf").select("s", F.concat("node", _from("s", F.col("p"))).alias("t"))
    reached = reached.filter("s != t").select(*[F.expr(f"left({c}, char_length({c}) - 1)").alias(c) for c in ("s", "t")])
    reached = reached.join(words.withColumnRenamed("word", "t"), "t", "left_semi").select("s", "t")
    parted = spark.read.parquet(ends).select("child", "s")
    within = parted.join(parted.withColumnRenamed("s", "t"), "child").filter("s < t").filter("levenshtein(s, t, 1) = 1").select("s", "t")
    pairs = reached.unionByName(within)
    return pairs.select(F.least("s", "t").alias("a"), F.greatest("s", "t").alias("b")).distinct()


def _written(states: DataFrame, base: str, depth: int) -> DataFrame:
    """Writes a frontier beside the earlier ones; those of its states that are not at a leaf go on."""
    path = f"{base}/level={depth}"
    states.write.parquet(path)  # every level has its own file set, so that a later one reads only what is new
    return states.sparkSession.read.schema(states.schema).parquet(path).filter("not leaf")


def spelling_forms(words: DataFrame, pairs: DataFrame, times: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each (word, n), given the near ``pairs`` (a, b).

    A word's form is its near word with the largest n, ties to the smallest in code-point order, if that n is at least ``times`` its own;
    root is where the forms end, the word itself without a form. As n grows from form to form, no cycle exists; roots are found by pointer doubling.
    """
    sided = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counted = sided.join(words.select(F.col("word").alias("b"), F.col("n").alias("m")), "b")
    best = counted.groupBy("a").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "b")).alias("best"))
    best = best.select(F.col("a").alias("word"), "n_near", F.col("best.b").alias("near"), (-F.col("best.m")).alias("m"))
    large = F.col("m") >= times * F.col("n")
    found = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(large, F.col("near")).alias("form"), F.when(large, F.col("m")).alias("form_n")
    )
    found = freeze(found, "forms")
    roots = found.filter("form is not null").select("word", F.col("form").alias("root"))
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = freeze(roots.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if roots.filter("moved").isEmpty():
            break
        roots = roots.select("word", "root")
    found = found.join(roots.select("word", "root"), "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = 7, fewest: int = 2, slip: int = 31, times: int = 10) -> DataFrame:
    """The words of ``corpus_words`` with their ``spelling_forms``; other columns of ``docs`` are ignored, an empty table gives no rows."""
    words = freeze(corpus_words(docs, id_col, text_col, shortest, fewest, slip), "counted")
    return spelling_forms(words, freeze(near_words(words), "near"), times)
