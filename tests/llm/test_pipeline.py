"""The stages of the corpus pipeline and their chain on a small table."""

import numpy as np
import pytest

import corpus_pipeline
from sumac.session import scratch_path
from tests.llm.test_corpus import brute_fingerprint, smallest

RNG = np.random.default_rng(3)
WORDS = ["".join(RNG.choice(list("abcdefghijklmnopqrstuvw"), int(n))) for n in RNG.integers(2, 9, 400)]


def prose(n):
    return " ".join(RNG.choice(WORDS, n))


PASSAGE = prose(70)
LINE = prose(12)
BODY = prose(80)
TEXTS = [prose(50) for _ in range(12)] + [None, "", f"{prose(20)}\n{LINE}", f"{prose(21)}\n{LINE}x", LINE, BODY, BODY, f"{BODY}.", f"{prose(10)} {PASSAGE}", f"{prose(10)} {PASSAGE} {prose(5)}"]
TEXTS += [f"{prose(20)} vilegrub snaddo{'' if k % 2 else 'x'} {prose(8)}" for k in range(20)] + [prose(30) for _ in range(20)]


@pytest.fixture(scope="module")
def folder(spark):
    path = scratch_path(spark, "pipeline")
    docs = [(k, t, "en", "web", len(t or "")) for k, t in enumerate(TEXTS)] + [(None, "no id", None, None, None)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    labels = [(k, 1, int("vilegrub" in (t or ""))) for k, t in enumerate(TEXTS) if k % 3]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def kept(df):
    return {r["doc_id"]: r["text"] or "" for r in df.collect()}


def test_stages(spark, folder):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "simhash", "substring_dedup", "packing"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    clean = stages["toxicity"](spark, docs, folder)
    bad = {k for k, t in enumerate(TEXTS) if "vilegrub" in (t or "")}
    found = kept(clean)
    assert not bad & set(found) and len(set(range(len(TEXTS))) - bad - set(found)) <= 2

    rows = {r["doc_id"]: r["text"] for r in docs.filter("doc_id is not null").collect()}
    lines = kept(stages["line_dedup"](spark, docs, folder))
    base = min(k for k, t in rows.items() if LINE in (t or ""))
    assert lines[base] == rows[base] and all(LINE not in lines.get(k, "") for k in rows if k != base)
    assert all(lines[k] == (rows[k] or "") for k in range(14))

    groups = smallest(len(TEXTS), [(a, b) for a in range(len(TEXTS)) for b in range(a) if (FPS[a] ^ FPS[b]).bit_count() <= 3])
    assert set(kept(stages["simhash"](spark, docs, folder))) == {k for k, g in enumerate(groups) if k == g}

    parts = kept(stages["substring_dedup"](spark, docs, folder))
    assert sum(PASSAGE in t for t in parts.values()) == 1 and set(parts) == set(rows)


FPS = [brute_fingerprint(t or "", 3) for t in TEXTS]


def test_run(spark, folder):
    out = corpus_pipeline.run(spark, folder).collect()
    ids = {r["doc_id"] for r in out}
    assert 0 < len(ids) < len(TEXTS) and not any("vilegrub" in (TEXTS[k] or "") for k in ids)
    per = {}
    for r in out:
        per.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in per.values():
        assert sum(n for _, n in pieces) <= 2048 and sorted(o for o, _ in pieces) == [sum(n for o2, n in pieces if o2 < o) for o in sorted(o for o, _ in pieces)]
