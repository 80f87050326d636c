"""Spelling variants, exact centroids and WARC archives against brute force, with nulls, ties, repeats and clashing columns."""

import base64
import glob
import gzip
import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sumac.llm import centroids as clusters, queries, spelling, warc
from sumac.llm.centroids import candidates, centroid_clusters, hilbert_keys
from sumac.llm.spelling import corpus_words, near_words, spelling_forms, spelling_groups
from sumac.llm.warc import parse_record, read_archives, write_archives
from sumac.session import scratch_path

RNG = np.random.default_rng(11)
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_near(words):
    found = set()
    for w in words:
        for k in range(len(w)):
            found.add((w, w[:k] + w[k + 1 :]))
    shorter = {(a, b) for a, b in found if b in words}
    masks = {}
    for w in words:
        for k in range(len(w)):
            masks.setdefault((w[:k], w[k + 1 :]), []).append(w)
    replaced = {(a, b) for ws in masks.values() for a in ws for b in ws if a < b}
    return {tuple(sorted(p)) for p in shorter if p[0] != p[1]} | replaced


def variants(stem, letters="abcdeé"):
    out = {stem}
    for k in range(len(stem)):
        out |= {stem[:k] + stem[k + 1 :], stem[:k] + letters[k % 6] + stem[k:], stem[:k] + letters[(k + 1) % 6] + stem[k + 1 :]}
    return out


WORDS = sorted(
    variants("abcabcab") | variants("straßenà") | {"a" * n for n in range(1, 60)} | {"x" * 900 + "y" + "z" * 800, "x" * 900 + "z" * 800, "x" * 901 + "z" * 800}
    | {"".join(RNG.choice(list("abé"), int(n))) for n in RNG.integers(1, 9, 300)}
)


@pytest.mark.parametrize("broadcast, leaf", [(100_000, 32), (5, 2)])
def test_near_words(spark, monkeypatch, broadcast, leaf):
    monkeypatch.setattr(spelling, "BROADCAST_NODES", broadcast)
    monkeypatch.setattr(spelling, "LEAF", leaf)
    words = WORDS if leaf == 32 else [w for w in WORDS if len(w) < 12]
    table = spark.createDataFrame([(w, 1) for w in [*words, "abcabcab", None]], "word string, s int").repartition(3)
    got = [tuple(r) for r in near_words(table).select("a", "b").collect()]
    assert len(got) == len(set(got)) and set(got) == brute_near(set(words))


def brute_groups(docs):
    counts = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or "") if doc is not None else []:
            run = run.translate(LOWER)
            h = zlib.crc32(f"{doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 7 and c >= 2}
    near = {w: [] for w in n}
    for a, b in brute_near(set(n)):
        near[a].append(b)
        near[b].append(a)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x.encode()), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    rows = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        rows.add((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return rows


def test_spelling_groups(spark):
    docs = [(k, " ".join(RNG.choice(["Straßenbahn", "walking", "ÀBCDEFGH", "committee", "x1", "walkingx"], 60))) for k in range(60)]
    docs += [(100, "walkingx walkinx " * 3 + "walkin"), (101, "commitee " * 2 + "comitee comitee"), (102, None), (103, ""), (104, "walking-Walking\nWALKING"), (None, "walkinggg walkinggg"), (104, "walking-Walking\nWALKING")]
    docs += [(105, "ab" * 3000 + " " + "ab" * 3000), (106, "ab" * 2999 + "b " + "ab" * 2999 + "b")]
    table = spark.createDataFrame([(d, t, "run", 1, "x") for d, t in docs], "doc_id long, text string, run string, n int, word string").repartition(3)
    got = [tuple(r) for r in spelling_groups(table).select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(got) == len(set(got)) and set(got) == brute_groups(docs)
    assert any(r[1] for r in got)
    assert spelling_groups(table.limit(0)).collect() == []


def test_forms_chain_and_ties(spark):
    n = {"aaaaaaa": 1000, "aaaaaab": 100, "aaaaabb": 10, "aaaabbb": 1, "zzzzzzz": 20, "zzzzzzy": 20, "zzzzzz": 2}
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    got = {r["word"]: r for r in spelling_forms(words, near_words(words)).collect()}
    assert {w: r["root"] for w, r in got.items()} == {**{w: "aaaaaaa" for w in n if w[0] == "a"}, "zzzzzzz": "zzzzzzz", "zzzzzzy": "zzzzzzy", "zzzzzz": "zzzzzzy"}
    assert got["zzzzzz"]["form"] == "zzzzzzy" and got["zzzzzzz"]["form"] is None and got["zzzzzzz"]["n_near"] == 2


def brute_clusters(rows, width, scale, count, rounds, seed):
    kept = [(i, np.floor(np.array(v, float) * scale).astype(object)) for i, v in rows if i is not None and v is not None and len(v) == width and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), [int(x) for x in r[1]]))
    points = [[int(x) for x in v] for _, v in kept]
    centres = [[int(x) for x in v] for _, v in order[:count]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(p, c)), k) for k, c in enumerate(centres)) for p in points]

    for _ in range(rounds):
        near = assign()
        for k in range(len(centres)):
            own = [p for p, (_, c) in zip(points, near) if c == k]
            if own:
                centres[k] = [sum(x) // len(own) for x in zip(*own)]
    near = assign()
    inertia = Counter()
    for d, k in near:
        inertia[k] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return Counter((i, k, d, inertia[k], sum(inertia.values()), digest[k]) for (i, _), (d, k) in zip(kept, near))


@pytest.mark.parametrize("block", [256, 7])
def test_centroid_clusters(spark, monkeypatch, block):
    monkeypatch.setattr(clusters, "BLOCK", block)
    base = RNG.normal(0, 1, (5, 6))
    rows = [(k, (base[k % 5] + RNG.normal(0, 0.2, 6)).tolist()) for k in range(150)]
    rows += [(200 + k, rows[0][1]) for k in range(60)] + [(3, rows[3][1]), (7, rows[8][1])]
    rows += [(300, None), (301, [1.0] * 5), (302, [1.0] * 7), (303, [1.0, None, 0, 0, 0, 0]), (304, [float("nan")] * 6), (305, [float("inf")] + [0.0] * 5), (None, [0.0] * 6), (306, [])]
    table = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "v", 1) for i, v in rows], "vec_id long, embedding array<double>, v string, place int")
    table = table.repartition(3)
    got = Counter(tuple(r) for r in centroid_clusters(table, width=6, scale=64).collect())
    assert got == brute_clusters(rows, 6, 64, 8, 10, 3)
    few = table.filter("vec_id < 3")
    assert Counter(tuple(r) for r in centroid_clusters(few, width=6, scale=64).collect()) == brute_clusters(rows[:3], 6, 64, 8, 10, 3)
    assert centroid_clusters(table.limit(0), width=6).collect() == []


def test_candidates_and_curve():
    for _ in range(200):
        low = RNG.integers(-20, 20, 4)
        high = low + RNG.integers(0, 12, 4)
        centres = RNG.integers(-30, 30, (6, 4))
        centres[5] = centres[1]
        points = RNG.integers(low, high + 1, (50, 4))
        nearest = ((points[:, None] - centres) ** 2).sum(axis=2).argmin(axis=1)
        assert set(nearest) <= set(candidates(low, high, centres))
    assert list(candidates(np.zeros(2, int), np.ones(2, int), np.array([[0, 0], [90, 90], [0, 0]]))) == [0]
    grid = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    order = [grid[k] for k in sorted(range(len(grid)), key=hilbert_keys(grid, 3).__getitem__)]
    assert all(np.abs(a - b).sum() == 1 for a, b in zip(order, order[1:]))


PAGES = [(k, f"http://h/{k}", f"<p>{k % 9}</p>" * (k % 4)) for k in range(80)]
PAGES += [(100, None, None), (101, "http://x/ä b\r\nWARC-Type: x", "ünï\r\n\r\nWARC/1.1\r\n"), (102, "", ""), (None, "u", "v"), (103, "u", "z" * 300_000), (103, "u", "z" * 300_000), (103, "w", "z" * 300_000), (99, "u", "z" * 300_000)]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame([(*p, "head", 5, "x") for p in PAGES], "page_id long, url string, html string, head string, shard int, payload string").repartition(3)


def brute_archive(smallest):
    kept = [(p, (h or "").encode()) for p, _, h in PAGES if p is not None]
    top = {}
    for p, data in kept:
        top[data] = max(p, top.get(data, p))
    out, taken = Counter(), set()
    for p, data in kept:
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        response = len(data) < smallest or (p == top[data] and data not in taken)
        if p == top[data]:
            taken.add(data)
        out[(p, len(data), digest, "response" if response else "revisit", None if response else top[data])] += 1
    return out


@pytest.mark.parametrize("smallest, shard, file", [(0, 1 << 30, 1 << 30), (10, 20_000, 900)])
def test_archives(spark, pages, smallest, shard, file):
    path = scratch_path(spark, "archives")
    manifest = write_archives(pages, path, smallest=smallest, shard_bytes=shard, file_bytes=file).orderBy("name").collect()
    found = read_archives(spark, path)
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert Counter(tuple(r) for r in found.select(*columns).collect()) == brute_archive(smallest)
    texts = {r["page_id"]: r["payload"].decode() for r in found.collect() if r["record_type"] == "response"}
    assert texts[103] == "z" * 300_000 and texts[101] == "ünï\r\n\r\nWARC/1.1\r\n"
    names = sorted(glob.glob(f"{path}/*.gz"))
    assert [r["name"] for r in manifest] == [n.rsplit("/", 1)[1] for n in names] and glob.glob(f"{path}/_temporary/*") == []
    ids = []
    for name in names:
        blob = gzip.decompress(open(name, "rb").read())
        assert blob.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
        ids += re.findall(rb"WARC-Record-ID: <urn:x-page:(\d+):", blob)
    assert ids == sorted(ids, key=int) and len(ids) == sum(r["records"] for r in manifest) == len(PAGES) - 1
    again = scratch_path(spark, "archives")
    write_archives(pages.repartition(7, "url"), again, smallest=smallest, shard_bytes=shard, file_bytes=file)
    assert [open(n, "rb").read() for n in names] == [open(n, "rb").read() for n in sorted(glob.glob(f"{again}/*.gz"))]


def test_damaged_archives_raise(spark, pages):
    path = scratch_path(spark, "archives")
    write_archives(pages, path)
    (name,) = glob.glob(f"{path}/*.gz")
    data = bytearray(open(name, "rb").read())
    data[len(data) // 2] ^= 1
    open(name, "wb").write(data)
    with pytest.raises(Exception):
        read_archives(spark, path).collect()
    with pytest.raises(ValueError):
        parse_record(b"WARC/1.1\r\nContent-Length: 3\r\nWARC-Block-Digest: sha1:A\r\n\r\nabc\r\n\r\n")
    empty = scratch_path(spark, "archives")
    write_archives(pages.limit(0), empty)
    assert read_archives(spark, empty).collect() == []


def test_queries_have_the_agreed_columns(spark):
    shapes = {
        "op11_spelling_variants": {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"},
        "op12_centroids": {"vec_id": "bigint", "cluster": "int", "distance": "bigint", "cluster_inertia": "bigint", "inertia": "bigint", "centroid_sha256": "string"},
        "op13_warc": {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string", "refers_to": "bigint"},
    }
    for name, shape in shapes.items():
        assert dict(queries.QUERIES[name](spark, "/root/testdata/sf0.001").dtypes) == shape
