"""Language-model scores by prediction by partial matching over bytes, beside a word base line."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from sumac.llm.texts import as_batch, id_and_text, slices
from sumac.session import freeze

#: Bytes that no UTF-8 text holds: the context before a text, and its end.
BEFORE, END = 0xFE, 0xFF
SYMBOLS = 256
#: Grams of the longest order that every task holds; the others are looked up in the whole table by a join.
COMMON_GRAMS = 1 << 22
#: Context bytes that name a group of the gram table: a group holds at most 2 ** 24 grams of six bytes.
NEAR = 3
#: Words whose counts every task holds; others are looked up by a join.
COMMON_WORDS = 1 << 18
#: Entries after which a task sends its partial counts on, and bytes scored at once.
PARTIAL, PIECE = 300_000, 1 << 20


def _gram_keys(texts: list[bytes], order: int) -> np.ndarray:
    """One number per byte and per text end: the byte below the ``order`` bytes before it."""
    pad = bytes([BEFORE]) * order
    joined = np.frombuffer(b"".join(pad + t + bytes([END]) for t in texts), np.uint8).astype(np.uint64)
    keys = np.zeros(max(0, len(joined) - order), np.uint64)
    for k in range(order + 1):
        keys = (keys << np.uint64(8)) | joined[k : k + len(keys)]
    # Drop the positions of the padding between texts.
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    starts = np.cumsum(sizes + order) - (sizes + order)
    keep = np.repeat(starts, sizes) + np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return keys[keep]


def _low(keys: np.ndarray, count: int) -> np.ndarray:
    """The last ``count`` bytes of each key."""
    return keys & np.uint64((1 << (8 * count)) - 1)


def _find(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The place of each key, -1 if it is not there."""
    if not len(sorted_keys):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == keys, at, -1)


class Trie:
    """Contexts of 0 to ``order`` bytes with the counts of the bytes that followed.

    A byte seen in the longest known context has probability n / (T + q), with T the context's
    total and q its number of distinct bytes; q / (T + q) is left for an escape to
    the next shorter context, where all bytes of the longer one are excluded: their counts leave
    the total, and the distinct bytes still new there estimate the next escape.

    With ``low``, grams are those of some groups of contexts only, and ``low`` holds the (grams, counts) of
    order NEAR - 1 over the whole table, from which that order and the shorter ones are taken.
    """

    def __init__(self, grams: np.ndarray, counts: np.ndarray, order: int, low: tuple[np.ndarray, np.ndarray] | None = None):
        self.order = order
        self.grams, self.counts, self.contexts = [None] * (order + 1), [None] * (order + 1), [None] * (order + 1)
        self.total, self.kinds = [None] * (order + 1), [None] * (order + 1)
        self.base, self.fresh = [None] * (order + 1), [None] * (order + 1)
        by = np.argsort(grams)
        grams, counts = grams[by].astype(np.uint64), counts[by].astype(np.float64)
        for k in range(order, -1, -1):
            if k < order and low is not None and k == NEAR - 1:
                grams, counts = low
            elif k < order:
                grams, back = np.unique(_low(self.grams[k + 1], k + 1), return_inverse=True)
                counts = np.bincount(back, self.counts[k + 1], len(grams))
            self.grams[k], self.counts[k] = grams, counts
            starts = np.flatnonzero(np.concatenate(([True], np.diff(grams >> np.uint64(8)) != 0))) if len(grams) else np.empty(0, np.int64)
            self.contexts[k] = grams[starts] >> np.uint64(8)
            self.total[k] = np.add.reduceat(counts, starts) if len(starts) else np.empty(0)
            self.kinds[k] = np.diff(np.append(starts, len(grams))).astype(np.float64)
            if k < order:
                # What is left in each longer context's parent once its own bytes are excluded.
                parent = _find(self.contexts[k], _low(self.contexts[k + 1], k))
                longer = self.grams[k + 1]
                there = counts[_find(grams, _low(longer, k + 1))]
                own = np.add.reduceat(there, self._starts(k + 1)) if len(longer) else np.empty(0)
                self.fresh[k + 1] = self.kinds[k][parent] - self.kinds[k + 1]
                self.base[k + 1] = self.total[k][parent] - own + self.fresh[k + 1]
        owner = np.repeat(np.arange(len(self.kinds[order])), self.kinds[order].astype(np.int64))
        values = np.log10(self.counts[order]) - np.log10((self.total[order] + self.kinds[order])[owner])
        self.bits = max(4, (2 * len(self.grams[order])).bit_length())
        self._fill(self.grams[order], values.astype(np.float32))

    def _starts(self, k: int) -> np.ndarray:
        return (np.cumsum(self.kinds[k]) - self.kinds[k]).astype(np.int64)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _fill(self, keys: np.ndarray, values: np.ndarray) -> None:
        size = 1 << self.bits
        self.keys, self.values = np.full(size, np.uint64(2**64 - 1)), np.zeros(size, np.float32)
        slots = self._slot(keys)
        while len(keys):
            open_ = np.flatnonzero(self.keys[slots] == np.uint64(2**64 - 1))
            _, first = np.unique(slots[open_], return_index=True)
            put = open_[first]
            self.keys[slots[put]], self.values[slots[put]] = keys[put], values[put]
            rest = np.ones(len(keys), bool)
            rest[put] = False
            keys, values, slots = keys[rest], values[rest], (slots[rest] + 1) & (size - 1)

    def log10(self, keys: np.ndarray) -> np.ndarray:
        """The log10 probability of each key's last byte after the bytes before it."""
        slots = self._slot(keys)
        there = self.keys[slots]
        out = self.values[slots].astype(np.float64)
        todo = np.flatnonzero(there != keys)
        missing = []
        slots, there = slots[todo], there[todo]
        while len(todo):
            empty = there == np.uint64(2**64 - 1)
            missing.append(todo[empty])
            todo, slots = todo[~empty], (slots[~empty] + 1) & ((1 << self.bits) - 1)
            there = self.keys[slots]
            hit = there == keys[todo]
            out[todo[hit]] = self.values[slots[hit]]
            todo, slots, there = todo[~hit], slots[~hit], there[~hit]
        if missing:
            todo = np.concatenate(missing)
            out[todo] = self._escaped(keys[todo])
        return out

    def _escaped(self, keys: np.ndarray) -> np.ndarray:
        out, open_ = np.zeros(len(keys)), np.arange(len(keys))
        above = np.full(len(keys), -1)  # the context one byte longer, if known
        for k in range(self.order, -1, -1):
            key, longer = keys[open_], above[open_]
            context = _find(self.contexts[k], _low(key >> np.uint64(8), k))
            gram = _find(self.grams[k], _low(key, k + 1)) if k < self.order else np.full(len(key), -1)
            first = (longer < 0) & (context >= 0)
            room = np.ones(len(key))
            room[first] = (self.total[k] + self.kinds[k])[context[first]]
            left = np.zeros(len(key))
            left[first] = self.kinds[k][context[first]]
            inner = longer >= 0
            if inner.any():
                room[inner] = self.base[k + 1][longer[inner]]
                left[inner] = self.fresh[k + 1][longer[inner]]
            found = (gram >= 0) & (context >= 0)
            out[open_[found]] += np.log10(self.counts[k][gram[found]] / room[found])
            escape = ~found & (first | inner) & (left > 0)
            out[open_[escape]] += np.log10(left[escape] / room[escape])
            above[open_] = np.where(context >= 0, context, -1)
            open_ = open_[~found]
        seen = self.kinds[0][0] if len(self.kinds[0]) else 0
        out[open_] -= math.log10(max(1, SYMBOLS - seen))
        return out

    def texts(self, texts: list[bytes]) -> np.ndarray:
        """The log10 probability of each text and its end."""
        out, at = np.zeros(len(texts)), 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) < PIECE):
                size += len(texts[end])
                end += 1
            if end == at + 1 and size > 4 * PIECE:
                out[at] = self._long(texts[at])
            else:
                logs = self.log10(_gram_keys(texts[at:end], self.order))
                sizes = np.fromiter(map(len, texts[at:end]), np.int64, end - at) + 1
                out[at:end] = np.add.reduceat(logs, np.cumsum(sizes) - sizes)
            at = end
        return out

    def _long(self, text: bytes) -> float:
        whole, total = bytes([BEFORE]) * self.order + text + bytes([END]), 0.0
        for at in range(0, len(text) + 1, PIECE):
            part = np.frombuffer(whole[at : at + PIECE + self.order], np.uint8).astype(np.uint64)
            keys = np.zeros(len(part) - self.order, np.uint64)
            for k in range(self.order + 1):
                keys = (keys << np.uint64(8)) | part[k : k + len(keys)]
            total += self.log10(keys).sum()
        return total


def _gram_counts(texts: DataFrame, order: int) -> DataFrame:
    def count(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged():
            keys, sums = (np.concatenate(x) for x in zip(*held))
            keys, back = np.unique(keys, return_inverse=True)
            return keys, np.bincount(back, sums, len(keys))

        def rows(keys, sums):
            return as_batch({"gram": pa.array(keys.astype(np.int64)), "n": pa.array(sums.astype(np.int64))})

        for batch in slices(batches):
            texts = [t.as_py() for t in batch.column("text")]
            for at in range(0, len(texts), 256):
                keys, sums = np.unique(_gram_keys(texts[at : at + 256], order), return_counts=True)
                held.append((keys, sums.astype(np.float64)))
                if sum(len(k) for k, _ in held) > 8 * PARTIAL:
                    held = [merged()]
                    if len(held[0][0]) > 4 * PARTIAL:
                        yield rows(*held.pop())
        if held:
            yield rows(*merged())

    sent = texts.mapInArrow(count, "gram long, n long")
    return sent.groupBy("gram").agg(F.sum("n").alias("n"))


def _order_up_to(grams: DataFrame, order: int) -> tuple[np.ndarray, np.ndarray]:
    """All grams of an order of at most NEAR - 1, hence at most 2 ** 24 of them, and their counts, in order."""
    mask = (1 << (8 * (order + 1))) - 1
    found = grams.groupBy(F.col("gram").bitwiseAND(F.lit(mask)).alias("gram")).agg(F.sum("n").alias("n")).orderBy("gram").toArrow()
    return found.column("gram").to_numpy().astype(np.uint64), found.column("n").to_numpy().astype(np.float64)


class Known:
    """Log10 probabilities of the most frequent grams."""

    def __init__(self, grams: np.ndarray, logs: np.ndarray):
        by = np.argsort(grams)
        self.grams, self.logs = grams[by], logs[by]

    def split(self, text: bytes, order: int):
        """Per piece of a text: (log10 probability of its listed grams, other grams, how often they occur)."""
        whole = bytes([BEFORE]) * order + text + bytes([END])
        for at in range(0, len(text) + 1, PIECE):
            part = np.frombuffer(whole[at : at + PIECE + order], np.uint8).astype(np.uint64)
            keys = np.zeros(len(part) - order, np.uint64)
            for k in range(order + 1):
                keys = (keys << np.uint64(8)) | part[k : k + len(keys)]
            keys, times = np.unique(keys, return_counts=True)
            place = _find(self.grams, keys)
            listed = place >= 0
            yield float(self.logs[place[listed]] @ times[listed]), keys[~listed], times[~listed]


def _frequent(grams: DataFrame, most: int) -> Known:
    """The logs of all grams that occur at least 2 ** k times, for the least k that leaves at most ``most`` of them."""
    power = F.floor(F.log2("n")).cast("int")
    sizes = {r["k"]: r["m"] for r in grams.groupBy(power.alias("k")).agg(F.count(F.lit(1)).alias("m")).collect()}
    least, held = 64, 0
    while least > 0 and held + sizes.get(least - 1, 0) <= most:
        least -= 1
        held += sizes.get(least, 0)
    context = F.shiftrightunsigned("gram", 8)
    rooms = grams.groupBy(context.alias("context")).agg((F.sum("n") + F.count(F.lit(1))).alias("room"))
    frequent = grams.filter(power >= least).withColumn("context", context)
    found = frequent.join(rooms, "context").select("gram", (F.log10("n") - F.log10("room")).alias("log")).toArrow()
    return Known(found.column("gram").to_numpy().astype(np.uint64), found.column("log").to_numpy())


def _looked_up(grams: DataFrame, wanted: DataFrame, order: int) -> DataFrame:
    """(gram, log): the log10 probability of each gram of ``wanted`` under the whole gram table.

    Both tables meet in groups of equal last NEAR context bytes. A group holds all that contexts of
    NEAR and more bytes can tell, and shorter contexts are in every task: at most 2 ** 24 grams.
    """
    low = grams.sparkSession.sparkContext.broadcast(_order_up_to(grams, NEAR - 1))
    group = F.shiftrightunsigned("gram", 8).bitwiseAND(F.lit((1 << (8 * NEAR)) - 1))
    both = grams.select("gram", "n").unionByName(wanted.select("gram", F.lit(None).cast("long").alias("n")))
    both = both.withColumn("part", group).repartition("part").sortWithinPartitions("part")

    def solve(tables: list[pa.RecordBatch]):
        table = pa.Table.from_batches(tables)
        keys = table.column("gram").to_numpy().astype(np.uint64)
        asked = table.column("n").is_null().to_numpy()
        if not asked.any():
            return
        trie = Trie(keys[~asked], table.column("n").drop_null().to_numpy(), order, low.value)
        logs = trie.log10(keys[asked])
        for at in range(0, len(logs), PARTIAL):
            yield as_batch({"gram": pa.array(keys[asked][at : at + PARTIAL].astype(np.int64)), "log": pa.array(logs[at : at + PARTIAL])})

    def run(batches):
        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            # A group is complete when the next one starts; whole groups are solved together.
            parts = batch.column("part").to_numpy()
            last = int(np.searchsorted(parts, parts[-1]))
            full = size + last > PARTIAL and (last > 0 or int(held[-1].column("part")[-1].as_py()) != int(parts[-1]))
            if full:
                yield from solve([*held, batch.slice(0, last)])
                held, size, batch = [], 0, batch.slice(last)
            held.append(batch)
            size += batch.num_rows
        if held:
            yield from solve(held)

    return both.mapInArrow(run, "gram long, log double")


def _word_counts(texts: DataFrame) -> DataFrame:
    def count(batches):
        held: Counter = Counter()

        def rows():
            return as_batch({"word": pa.array(list(held), pa.binary()), "c": pa.array(list(held.values()), pa.int64())})

        for batch in slices(batches):
            for text in batch.column("text"):
                held.update(text.as_py().lower().split())
                if len(held) > PARTIAL:
                    yield rows()
                    held = Counter()
        if held:
            yield rows()

    return texts.mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def score(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", order: int = 5) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every document.

    ``train`` (an expression over doc_id) names the documents to learn from. ``score`` is the
    log10 probability of the text's bytes and its end under the trie. ``base_score`` sums
    log10((c + 1) / (N + V + 1)) over the lower-cased words and one end, with counts from the training texts.
    Counts of the most frequent words and probabilities of the most frequent grams are in every task; other
    words and grams go through joins, so both tables may grow with the input: the model is the same at every size.

    Null texts are empty; rows without an id are left out; repeated rows are scored, and
    learnt, each; other columns are ignored. Without training texts every symbol is equally likely.
    """
    spark = docs.sparkSession
    texts = id_and_text(docs, id_col, text_col)
    learnt = texts.filter(train)
    if not 0 <= order <= 6:
        raise ValueError("order must be 0 to 6")
    grams = freeze(_gram_counts(learnt, order), "grams")
    # Few grams: the whole model is in every task. Otherwise only what is frequent is; the scores are the same.
    held = order < NEAR or grams.count() <= COMMON_GRAMS
    if held:
        found = grams.toArrow()
        model = Trie(found.column("gram").to_numpy().astype(np.uint64), found.column("n").to_numpy(), order)
    else:
        model = _frequent(grams, COMMON_GRAMS)
    model = spark.sparkContext.broadcast(model)
    words = freeze(_word_counts(learnt), "words")
    n_docs = learnt.count()
    n, v = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    n, v = n + n_docs, v + (n_docs > 0)
    top = words.orderBy(F.desc("c"), "word").limit(COMMON_WORDS).toArrow()
    whole = v - (n_docs > 0) <= COMMON_WORDS  # then an unlisted word is an unknown one
    common = spark.sparkContext.broadcast({w: float(c) for w, c in zip(top.column("word").to_pylist(), top.column("c").to_pylist())})
    room = math.log10(n + v + 1)

    def make():
        logs = {w: math.log10(c + 1) for w, c in common.value.items()}
        task = TaskContext.get().partitionId() << 40
        done = 0

        def work(batch):
            nonlocal done
            values = [t.as_py() for t in batch.column("text")]
            out = {k: [] for k in ("n_tokens", "known", "base", "rare")}
            for value in values:
                tokens = value.lower().split()
                counted = Counter(tokens)
                listed = counted.keys() & logs.keys()
                out["n_tokens"].append(len(tokens) + 1)
                out["known"].append(sum(counted[w] for w in listed) + (n_docs > 0))
                out["base"].append(math.fsum(logs[w] * counted[w] for w in listed) + math.log10(n_docs + 1) - room * (len(tokens) + 1))
                out["rare"].append([] if whole else [{"word": w, "times": counted[w]} for w in counted.keys() - listed])
            rows = np.arange(done, done + len(values)) + task
            done += len(values)
            whole_rows = {
                "row": pa.array(rows, pa.int64()),
                "doc_id": batch.column("doc_id"),
                "n_tokens": pa.array(out["n_tokens"], pa.int64()),
                "known": pa.array(out["known"], pa.int64()),
                "base": pa.array(out["base"], pa.float64()),
                "rare": pa.array(out["rare"], kinds["rare"]),
            }
            if held:
                scores = pa.array(model.value.texts(values), pa.float64())
                yield as_batch({**whole_rows, "score": scores, "grams": pa.nulls(len(values), kinds["grams"])})
                return
            yield as_batch({**whole_rows, "score": pa.array(np.zeros(len(values))), "grams": pa.nulls(len(values), kinds["grams"])})
            # Beside them, a row for each piece of a text, with the grams that no task holds.
            pieces, size = [], 0
            for row, value in zip(rows, values):
                for piece in model.value.split(value, order):
                    pieces.append((row, *piece))
                    size += len(piece[1])
                    if size > PARTIAL:
                        yield piece_rows(pieces)
                        pieces, size = [], 0
            if pieces:
                yield piece_rows(pieces)

        return work

    kinds = {
        "rare": pa.list_(pa.struct([("word", pa.binary()), ("times", pa.int64())])),
        "grams": pa.list_(pa.struct([("gram", pa.int64()), ("times", pa.int64())])),
    }

    def piece_rows(pieces):
        rows, scores, keys, times = zip(*pieces)
        pairs = [pa.array(np.concatenate(keys).astype(np.int64)), pa.array(np.concatenate(times))]
        ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
        empty = pa.nulls(len(rows), pa.int64())
        return as_batch(
            {
                **{"row": pa.array(rows, pa.int64()), "doc_id": empty, "n_tokens": empty, "known": empty},
                "base": pa.nulls(len(rows), pa.float64()),
                "rare": pa.nulls(len(rows), kinds["rare"]),
                "score": pa.array(scores),
                "grams": pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(pairs, ["gram", "times"])),
            }
        )

    def run(batches):
        work = make()
        for batch in slices(batches):
            yield from work(batch)

    shape = (
        "row long, doc_id long, n_tokens long, known long, base double, rare array<struct<word: binary, times: bigint>>, "
        "score double, grams array<struct<gram: bigint, times: bigint>>"
    )
    sent = freeze(texts.mapInArrow(run, shape), "scored")
    rare = sent.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.times")
    looked = (
        rare.join(words, "word")
        .groupBy("row")
        .agg(F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("more"), F.sum("times").alias("also"))
    )
    scored = sent.drop("rare", "grams")
    if not held:
        asked = sent.select("row", F.explode("grams").alias("g")).select("row", "g.gram", "g.times")
        logs = _looked_up(grams, asked.select("gram").distinct(), order)
        found = asked.join(logs, "gram").groupBy("row").agg(F.sum(F.col("times") * F.col("log")).alias("score"))
        scored = scored.unionByName(found, allowMissingColumns=True).groupBy("row").agg(
            *[F.max(c).alias(c) for c in ("doc_id", "n_tokens", "known", "base")], F.sum("score").alias("score")
        )
    return scored.join(looked, "row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("known") + F.coalesce("also", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        "score",
    )
