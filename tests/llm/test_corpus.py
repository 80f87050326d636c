"""The corpus operators against brute force on small tables with nulls, ties, repeats and clashing columns."""

import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from sumac.llm import idcoder
from sumac.llm.bpe import Merger, decode, encode, read_ranks
from sumac.llm.components import components
from sumac.llm.idfiles import ids_crc32, read_ids, write_ids
from sumac.llm.knn import top_inner_products
from sumac.llm.lines import deduplicated_lines
from sumac.llm.packing import pack_lengths, packed_sequences
from sumac.llm.ppm import Trie, _gram_keys, score as ppm_score
from sumac.llm.rangejoin import cosine_groups
from sumac.llm.simhash import _linked_in_chunks, simhash_groups
from sumac.llm.substrings import without_repeats
from sumac.llm.toxicity import fit, score as toxicity_score
from sumac.session import scratch_path

RNG = np.random.default_rng(5)
VOCABULARY = ["of", "the", "tion", "an", "reouth", "é", "Straße", "x1", "don't", "a.b", "ñandú", "lla"]


def sentence(n):
    return " ".join(RNG.choice(VOCABULARY, n))


PASSAGE = sentence(60)
TEXTS = (
    [None, "", "   \n\t ", "one", "a" * 6000, sentence(5000), PASSAGE, PASSAGE, f"head {PASSAGE} tail", f"{sentence(30)}\n{PASSAGE}\n{sentence(9)}"]
    + [sentence(int(n)) for n in RNG.integers(1, 120, 30)]
    + ["x \x1c y \x85 z  \xa0 w v", "A\nB\nB\n\nA", "\n\n", "'s 'S don't  \n \n  end ", "<|endoftext|> word"]
)
SHAPE = "doc_id long, text string, lang string, ids string, word string, fp string, kept string, starts string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, None, "ids", None, "fp", "kept", None) for k, t in enumerate(TEXTS)] + [(None, "no id", *[None] * 6)]
    return spark.createDataFrame(rows, SHAPE).repartition(3).cache()


def text(k):
    return TEXTS[k] or ""


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def smallest(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return [find(k) for k in range(n)]


def test_components(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 130)] + [(200, 200), (300, 299)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame([*links, (None, 3)], "a long, b long")).collect()}
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 130)} | {299: 299, 300: 299}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def brute_fingerprint(value, shingle):
    words = value.encode().lower().split()
    n = max(1, len(words) - shingle + 1)
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[k : k + shingle]), 42) for k in range(n)] if words else []
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_simhash(docs):
    fps = [brute_fingerprint(text(k), 3) for k in range(len(TEXTS))]
    links = [(a, b) for a in range(len(fps)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 3]
    groups, got = smallest(len(fps), links), by_id(simhash_groups(docs))
    assert {k: (r["fp"] % 2**64, r["component_id"]) for k, r in got.items()} == {k: (fps[k], groups[k]) for k in range(len(fps))}
    assert simhash_groups(docs.limit(0)).collect() == []


def test_simhash_chunks_connect_what_pairs_connect():
    import pandas as pd

    base = RNG.integers(0, 2**63, 30)
    fps = np.unique(np.concatenate([base ^ (1 << int(b)) for b in RNG.integers(0, 62, 12)] + [base]))
    links = [(a, b) for a in range(len(fps)) for b in range(a) if (int(fps[a]) ^ int(fps[b])).bit_count() <= 3]
    place = {int(f): k for k, f in enumerate(fps)}
    found = _linked_in_chunks(pd.DataFrame({"fp": fps}), 3)
    assert smallest(len(fps), links) == smallest(len(fps), [(place[x], place[y]) for x, y in found.itertuples(index=False)])


def test_lines(docs):
    lines = [(k, n, line) for k in range(len(TEXTS)) for n, line in enumerate(text(k).split("\n")) if line.strip(" \t\r\f\v")]
    sets = [{x[k : k + 5] for k in range(len(x) - 4)} or {x} for _, _, x in lines]
    links = [(a, b) for a in range(len(lines)) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    late = Counter(lines[k][0] for k, g in enumerate(smallest(len(lines), links)) if k != g)
    got = by_id(deduplicated_lines(docs))
    assert {k: r["n_removed"] for k, r in got.items()} == {k: late[k] for k in range(len(TEXTS))}
    assert got[TEXTS.index("A\nB\nB\n\nA")]["text"] == "A\nB\n"
    assert got[0]["text"] == "" and got[0]["n_lines"] == 1
    assert deduplicated_lines(docs.limit(0)).collect() == []


def brute_lines_removed(lines):
    """How many of these lines, in this order, stand after another one of their group."""
    sets = [{x[k : k + 5] for k in range(len(x) - 4)} or {x} for x in lines]
    links = [(a, b) for a in range(len(lines)) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    return sum(k != g for k, g in enumerate(smallest(len(lines), links)))


def test_lines_with_an_early_insertion_in_a_long_run(spark):
    own, lines = np.random.default_rng(7), []

    def letters(n):
        return "".join(own.choice(list("abcdefghijklmnopqrstuvwxyz"), n))

    for _ in range(60):
        head, tail, run = " ".join(letters(6) for _ in range(6)), letters(52), letters(119)
        lines += [f"{head} www.{tail}", f"{head} www2.{tail}", run, "#" + run]
    table = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    assert brute_lines_removed(lines) == 120
    assert sum(r["n_removed"] for r in deduplicated_lines(table).collect()) == 120


def test_lines_are_shuffled_once(spark, monkeypatch):
    from sumac.llm.lines import _each_shingle, _lines, _signatures, shingles

    rows = [(k, "é1\U0001f600x\t"[: k % 6] + "abcdefghij" * (k // 2) + "."[: k % 3]) for k in range(30)]
    lines = _lines(spark.createDataFrame(rows, "doc_id long, text string"))
    whole = Counter((r["doc_id"], r["line"][k : k + 5]) for r in lines.collect() for k in range(max(1, len(r["line"]) - 4)))
    assert Counter((r["doc_id"], s) for r in lines.select("doc_id", shingles(F.col("line"), 5).alias("s")).collect() for s in r["s"]) == whole
    assert Counter((r["doc_id"], r["shingle"]) for r in _each_shingle(lines, 5, "doc_id").collect()) == whole
    # Neither the lines nor their signatures go over the wire twice, and a signature takes 16 bits a hash.
    signed = _signatures(lines, 32, 5)
    plan = signed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert all(0 <= r[f"m{j}"] < 65536 for r in signed.collect() for j in range(32))
    monkeypatch.setattr("sumac.llm.lines.BANDS_AT_ONCE", 5)
    table = spark.createDataFrame([(1, "one line of some words\nx"), (2, "One line of some words"), (3, "x\nother")], "doc_id long, text string")
    assert {k: r["n_removed"] for k, r in by_id(deduplicated_lines(table)).items()} == {1: 0, 2: 1, 3: 1}


def test_a_shingle_meets_few_constants(spark):
    from sumac.llm.lines import SHARES, _hashed, _lines, _profiles, _signatures

    own, rows = np.random.default_rng(9), []
    for k in range(80):
        text = "".join(own.choice(list("abcdefghijklmnopqrstuvwxyzé"), 200))
        rows += [(2 * k, text), (2 * k + 1, text[:178] + "".join(own.choice(list("0123456789"), 22)))]  # 174 of 218 shingles in both
    rows += [(160, "ab"), (161, "abcdef"), (162, "abcdeg")]
    lines = _lines(spark.createDataFrame(rows, "doc_id long, text string"))
    signed = _signatures(lines, 32, 5)
    plan = signed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_min(") == 32 // SHARES
    found = {r["doc_id"]: [r[f"m{j}"] for j in range(32)] for r in signed.join(_hashed(lines), ["h1", "h2"]).collect()}
    agree = [np.mean([a == b for a, b in zip(found[2 * k], found[2 * k + 1])]) for k in range(80)]
    assert abs(np.mean(agree) - 174 / 218) < 0.05
    # A line of few shingles leaves shares empty; they have values of its own, so that short lines do not all look the same.
    assert None not in found[160] and not set(found[160]) & set(found[161]) and len(set(found[160])) == 32 // SHARES
    profiles = _profiles(lines.select(F.col("doc_id").alias("id"), "line"), 5)
    assert profiles._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    for r in profiles.collect():
        text = dict(rows)[r["id"]]
        different = len({text[k : k + 5] for k in range(max(1, len(text) - 4))})
        assert r["size"] == max(1, len(text) - 4) and r["bits"] == sum(bin(r[f"b{k}"] & (2**64 - 1)).count("1") for k in range(16))
        assert 0.8 * different <= r["bits"] <= different


def test_tidy_writes_leave_no_shuffle_files(spark):
    from sumac.session import CLEANUP, freeze

    def files():
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {found.apply(k).getName() for k in range(found.size())}

    before, conf = files(), spark.conf.get(CLEANUP, None)
    counted = freeze(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "tidy", tidy=True)
    for _ in range(50):  # files go soon after the write, not within it
        if not (left := {f for f in files() - before if f.startswith("shuffle_")}):
            break
        time.sleep(0.1)
    assert not left and counted.count() == 7 and spark.conf.get(CLEANUP, None) == conf


def test_lines_of_one_template_in_hot_bands(spark, monkeypatch):
    own = np.random.default_rng(8)
    words = ["".join(own.choice(list("abcdefghijklmnopqrstuvwxyz"), 7)) for _ in range(400)]
    template, lines = " ".join(own.choice(words, 16)), []
    for _ in range(400):
        varying = list(own.choice(words, 5))
        lines += [f"{template} {' '.join(varying)}", f"{template} {' '.join(varying[:4])} {own.choice(words)}"]
    order = own.permutation(len(lines))
    lines = [lines[k] for k in order]
    table = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string").repartition(3)
    wanted = brute_lines_removed(lines)
    assert wanted >= 300
    monkeypatch.setattr("sumac.llm.lines.CHUNK", 100)
    assert sum(r["n_removed"] for r in deduplicated_lines(table).collect()) == wanted


def test_bpe(docs):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = read_ranks(path)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = by_id(decode(encode(docs, path, public_tokenizers.PATTERN), path))
    assert {k: r["ids"] for k, r in got.items()} == {k: library.encode_ordinary(text(k)) for k in range(len(TEXTS))}
    assert all(bytes(r["decoded"]) == text(k).encode() for k, r in got.items())
    marks = "".join(map(chr, [*range(1, 0x2100), 0x3000, 0xFEFF, 0x1F600]))
    words = [marks[k : k + 3] for k in range(0, len(marks), 3)]
    ids, sizes = Merger(ranks).encode([w.encode() for w in words])
    assert np.split(ids, np.cumsum(sizes)[:-1])[40].tolist() == library._core_bpe.encode_single_piece(words[40].encode())


def brute_kept(window):
    seen, kept = set(), {}
    for k in range(len(TEXTS)):
        words, gone = text(k).encode().split(), set()
        for at in range(len(words) - window + 1):
            key = tuple(words[at : at + window])
            gone |= set(range(at, at + window)) if key in seen else set()
            seen.add(key)
        kept[k] = (len(words), len(gone), b" ".join(w for n, w in enumerate(words) if n not in gone).decode())
    return kept


def test_substrings(docs):
    for options in ({"window": 20}, {"window": 50, "period": 31, "cover": (1, 5, 11, 24, 25, 27)}, {"window": 8, "period": 7, "cover": (1, 2, 4)}):
        got = by_id(without_repeats(docs, **options))
        assert {k: (r["n_words"], r["n_removed"], r["kept"]) for k, r in got.items()} == brute_kept(options["window"])
    same = by_id(without_repeats(docs, carry=("lang", "ids"), as_written=True))
    assert same[10]["kept"] == TEXTS[10] and same[10]["ids"] == "ids"
    assert without_repeats(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        without_repeats(docs, cover=(0, 1))


def test_packing(docs, spark):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    model.encode_special_tokens = True
    rows = packed_sequences(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=256).collect()
    for k in range(len(TEXTS)):
        ids = np.array([*model.encode(text(k), add_special_tokens=False).ids, 0], "<u4")
        own = sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows if r["doc_id"] == k)
        assert own == [(n, at, len(ids[at : at + 256]), zlib.crc32(ids[at : at + 256].tobytes())) for n, at in enumerate(range(0, len(ids), 256))]
    for sequence in {r["sequence_id"] for r in rows}:
        at = 0
        for r in sorted((r for r in rows if r["sequence_id"] == sequence), key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 256
    sizes = RNG.integers(1, 2049, 3000)
    bins, _ = pack_lengths(sizes, 2048)
    assert np.bincount(bins, sizes).max() <= 2048 and bins.max() + 1 <= sizes.sum() / 2048 * 1.02 + 1


def test_id_files(docs, spark):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    model.encode_special_tokens = True
    path = scratch_path(spark, "test-ids")
    write_ids(docs, public_tokenizers.path("byte_bpe_50k.json"), path, end_id=2, vocabulary=50257, parts=3)
    got, start = by_id(ids_crc32(read_ids(spark, path, 50257))), 0
    for k in range(len(TEXTS)):
        ids = np.array([*model.encode(text(k), add_special_tokens=False).ids, 2], "<u4")
        assert (got[k]["start"], got[k]["n_tokens"], got[k]["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_range_coder():
    blocks = [RNG.integers(0, high, size) for high, size in ((1, 300), (2, 0), (50, 4096), (50257, 700), (50257, 1))]
    coded = idcoder.encode_blocks(blocks, 50257)
    assert [b.tolist() for b in idcoder.decode_blocks(coded, [len(b) for b in blocks], 50257)] == [b.tolist() for b in blocks]
    assert len(coded[2]) < 2 * len(blocks[2])  # less than plain 16-bit numbers
    broken = [coded[2][:40] + bytes([coded[2][40] ^ 1]) + coded[2][41:]]
    with pytest.raises(ValueError):
        idcoder.decode_blocks(broken, [4096], 50257)


def test_range_coder_memory():
    import tracemalloc

    own = np.random.default_rng(9)
    blocks = [own.integers(0, 60, 4096).astype(np.int32) for _ in range(64)]
    tracemalloc.start()
    coded = idcoder.encode_blocks(blocks, 50257)
    encoding = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    decoded = idcoder.decode_blocks(coded, [4096] * 64, 50257)
    decoding = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert all((a == b).all() for a, b in zip(blocks, decoded))
    assert max(encoding, decoding) < 20 * 64 * 4096  # bytes an id


def test_joined_units():
    from sumac.llm.tokens import TextEncoder, by_units, read_tokenizer

    made = TextEncoder(read_tokenizer(public_tokenizers.path("byte_bpe_50k.json")), by_units, 1000)
    texts = [*(text(k) for k in range(len(TEXTS))), "", " ", "  x", "\n\n a  b \t c <|endoftext|>x", " \u00e9t\u00e9 \u4f60\u597d \U0001f600 ", "a \x1c b  \u180e z"]
    wanted = [made.model.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids.tolist() for ids in made.ids([t.encode() for t in texts])] == wanted
    made = TextEncoder(read_tokenizer(public_tokenizers.path("byte_bpe_50k.json")), by_units, 1000)
    made.counts = made.counts + 1  # lengths that fit nowhere
    assert [ids.tolist() for ids in made.ids([t.encode() for t in texts])] == wanted


def test_ppm(docs):
    keys, counts = np.unique(_gram_keys([b"abracadabra", b"abc", b""], 3), return_counts=True)
    trie = Trie(keys, counts, 3)
    for context in (b"abr", b"xyz", b"\xfe\xfea", b"zab"):
        every = np.array([int.from_bytes(context, "big") << 8 | s for s in range(256)], np.uint64)
        assert (10 ** trie.log10(every)).sum() == pytest.approx(1)
    train = F.col("doc_id") % 3 != 0
    learnt = [text(k).encode().lower().split() for k in range(len(TEXTS)) if k % 3]
    counts = Counter(w for ws in learnt for w in ws)
    n, v = sum(counts.values()) + len(learnt), len(counts) + 1
    got = by_id(ppm_score(docs, train))
    for k in range(len(TEXTS)):
        words = text(k).encode().lower().split()
        base = sum(np.log10((c + 1) / (n + v + 1)) for c in [*(counts[w] for w in words), len(learnt)])
        assert got[k]["base_score"] == pytest.approx(base) and got[k]["train_tokens"] == n
        assert (got[k]["n_tokens"], got[k]["n_known"]) == (len(words) + 1, sum(counts[w] > 0 for w in words) + 1)
    assert got[30]["score"] > -3 * len(text(30).encode())
    assert all(r["score"] <= 0 for r in by_id(ppm_score(docs, F.lit(False))).values())


def plain_ppm(learnt, texts, order):
    """PPM with exclusion, symbol by symbol over dictionaries of contexts."""
    follows = {}
    for t in learnt:
        whole = b"\xfe" * order + t + b"\xff"
        for at in range(order, len(whole)):
            for k in range(order + 1):
                follows.setdefault(whole[at - k : at], Counter())[whole[at]] += 1

    def log(context, symbol):
        out, seen = 0.0, set()
        for k in range(order, -1, -1):
            counts = {s: n for s, n in follows.get(context[len(context) - k :], {}).items() if s not in seen}
            if not counts:
                continue
            room = sum(counts.values()) + len(counts)
            if symbol in counts:
                return out + np.log10(counts[symbol] / room)
            out += np.log10(len(counts) / room)
            seen |= counts.keys()
        return out - np.log10(256 - len(seen))

    wholes = [b"\xfe" * order + t + b"\xff" for t in texts]
    return [sum(log(w[at - order : at], w[at]) for at in range(order, len(w))) for w in wholes]


@pytest.mark.parametrize("order, piece", [(5, 1 << 20), (3, 1000)])
def test_ppm_beyond_the_held_grams(docs, monkeypatch, order, piece):
    """The scores of the whole order, with all grams held or a tenth of them, and in pieces of long texts."""
    train = F.col("doc_id") % 3 != 0
    texts = [text(k).encode() for k in range(len(TEXTS))]
    learnt = [t for k, t in enumerate(texts) if k % 3]
    want = plain_ppm(learnt, texts, order)
    grams = len({bytes(w) for t in learnt for w in zip(*[(b"\xfe" * order + t + b"\xff")[k:] for k in range(order + 1)])})
    whole = by_id(ppm_score(docs, train, order=order))
    monkeypatch.setattr("sumac.llm.ppm.COMMON_GRAMS", grams // 10)
    monkeypatch.setattr("sumac.llm.ppm.PIECE", piece)
    monkeypatch.setattr("sumac.llm.ppm.PARTIAL", 100)
    few = by_id(ppm_score(docs, train, order=order))
    for k, score in enumerate(want):
        assert whole[k]["score"] == pytest.approx(score, rel=1e-5)
        assert few[k]["score"] == pytest.approx(score, rel=1e-5)
        assert {c: v for c, v in few[k].asDict().items() if c != "score"} == {c: v for c, v in whole[k].asDict().items() if c != "score"}
    empty = docs.filter("doc_id < 0")
    assert ppm_score(empty, train, order=order).count() == 0


@pytest.fixture(scope="module")
def vectors(spark):
    x = RNG.normal(size=(300, 6)).astype("float32")
    x[50:120] = x[50]
    x[130:140] = x[130] + RNG.normal(size=(10, 6)).astype("float32") * 0.05
    rows = [(k, x[k].tolist(), 1, "v") for k in range(300)]
    rows += [(300, None, 1, "v"), (301, [0.0] * 6, 1, "v"), (302, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1, "v"), (303, [float("nan")] * 6, 1, "v"), (None, [1.0] * 6, 1, "v")]
    return x, spark.createDataFrame(rows, "vec_id long, embedding array<float>, cell int, v string")


def test_top_inner_products(vectors, monkeypatch):
    x, df = vectors
    whole = np.floor(x.astype(float) * 256).astype(np.int64)
    whole = np.vstack([whole, np.zeros((1, 6), np.int64)])
    ids = np.array([*range(300), 301])
    monkeypatch.setattr("sumac.llm.knn.BLOCK", 40)
    good = df.filter(F.col("vec_id").isNotNull()).withColumn("v", F.transform("embedding", lambda v: F.floor(v.cast("double") * 256).cast("long")))
    good = good.filter("vec_id < 300 or vec_id = 301")
    got = {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in top_inner_products(good, F.col("vec_id") % 50 == 0, k=5).collect()}
    want = set()
    for row in np.flatnonzero(ids % 50 == 0):
        scores = whole @ whole[row]
        best = [k for k in np.lexsort((ids, -scores)) if k != row][:5]
        want |= {(int(ids[row]), n + 1, int(ids[k]), int(scores[k])) for n, k in enumerate(best)}
    assert got == want


def test_cosine_groups(vectors, monkeypatch):
    x, df = vectors
    monkeypatch.setattr("sumac.llm.rangejoin.ROOT_SHARE", 2)
    for name, size in (("BLOCK", 7), ("GUEST_CELLS", 50), ("CHUNK", 5)):
        monkeypatch.setattr(f"sumac.llm.rangejoin.{name}", size)
    y = x.astype(float)
    y /= np.sqrt((y * y).sum(axis=1))[:, None]
    linked = y @ y.T >= 0.95
    groups = smallest(300, zip(*np.nonzero(linked)))
    want = {k: (int(linked[k].sum()) - 1, groups[k]) for k in range(300)} | {k: (0, k) for k in range(300, 304)}
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in cosine_groups(df).collect()} == want


def test_toxicity(spark, docs):
    insults = ["blorgface", "snarkle"]
    rows, labels = [], []
    for k in range(240):
        bad = k % 4 == 0
        words = RNG.choice(VOCABULARY, 30).tolist()
        if bad:
            words[5] = insults[k % 8 // 4]
            words[9] = {0: "blorg.face", 1: "snarkkle"}[k % 8 // 4] if k % 3 == 0 else words[9]
        rows.append((k, " ".join(words)))
        labels.append((k, int(bad)))
    table, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([*labels, (None, 1), (7, None)], "doc_id long, toxic int")
    model = fit(table, known, train=F.col("doc_id") % 5 != 0)
    got = {r["doc_id"]: r["score"] for r in toxicity_score(table, model).collect()}
    assert sum((got[k] >= 0.5) == bool(bad) for k, bad in labels) >= 232
    tricky = spark.createDataFrame([(1, "of the blorrgface an"), (2, "of b l o r g f a c e an"), (3, "of the tion an"), (4, None)], "doc_id long, text string")
    marked = {r["doc_id"]: r["score"] >= 0.5 for r in toxicity_score(tricky, model).collect()}
    assert marked == {1: True, 2: True, 3: False, 4: False}
    nothing = fit(table, known.limit(0))
    assert all(0 <= r["score"] <= 1 for r in toxicity_score(docs, nothing).collect())
