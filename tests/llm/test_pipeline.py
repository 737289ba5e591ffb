"""The pipeline's stages in order, on a corpus with planted copies and toxic documents; the entry's guard."""

import collections
import random
import re

import corpus_pipeline as P
from reviewspark.llm import bpe
from reviewspark.session import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def planted(tmp):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("aeiourstln") for _ in range(rng.randrange(3, 8)))
    docs, labels, fate = [], [], {}

    def add(text, kind, toxic=None):
        i = len(docs)
        docs.append((i, text, "en", f"src{i % 4}", len(text or "")))
        fate[i] = kind
        if toxic is not None:
            labels.append((i, 1, toxic))
        return i

    for k in range(700):
        w = [word() for _ in range(rng.randrange(20, 120))]
        if k % 6 == 0:
            for _ in range(rng.randrange(1, 4)):
                w.insert(rng.randrange(len(w)), rng.choice(["scum,", "moron", "Idiot!"]))
            add(" ".join(w), "toxic", 1 if k // 6 % 3 else None)
        else:
            add(" ".join(w), "clean", 0 if k % 3 else None)
    clean = [i for i, k in fate.items() if k == "clean"]
    for i in clean[:30]:
        add("\n ".join(docs[i][1].split(" ")), "exact")
    for _ in range(300):
        add(docs[clean[40]][1], "exact")                            # a hot text
    for i in clean[50:70]:
        w = docs[i][1].split(" ")
        if len(w) > 60:
            w[5] = "changed"
            add(" ".join(w), "near")
    add(None, "clean")
    return docs, labels, fate


def test_stages(spark, tmp_path):
    docs, labels, fate = planted(tmp_path)
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(docs, schema).repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert [n for n, _ in P.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mixing", "byte_bpe"]
    now = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in P.STAGES[:3]:
        now = materialize(stage(spark, now, str(tmp_path)), f"t-{name}")
        assert now.columns == COLUMNS
        left = collections.Counter(fate[r.doc_id] for r in now.select("doc_id").collect())
        if name == "toxicity":
            assert left["toxic"] <= 3 and left["clean"] >= 0.98 * sum(k == "clean" for k in fate.values())
        if name == "exact_dedup":
            assert left["exact"] == 0
    assert left["near"] == 0 and left["clean"] > 500
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    before = now.collect()
    size = collections.Counter()
    for r in before:
        size[r.source] += words(r.text)
    mixed = materialize(P.mix_sources(spark, now, str(tmp_path)), "t-mix")
    assert mixed.columns == COLUMNS
    rows = mixed.collect()
    assert max(collections.Counter(r.doc_id for r in rows).values()) <= 2
    got = collections.Counter()
    for r in rows:
        got[r.source] += words(r.text)
    rest, open_, want = 1.5 * sum(size.values()), sorted(size), {}
    weight = dict(zip(open_, (5, 2, 1, 5)))
    while open_:
        unit = rest / sum(weight[s] for s in open_)
        over = [s for s in open_ if unit * weight[s] > 2 * size[s]]
        want |= {s: 2 * size[s] if over else unit * weight[s] for s in over or open_}
        rest, open_ = rest - sum(want[s] for s in over), [s for s in open_ if s not in over] if over else []
    for s in size:
        assert abs(got[s] - want[s]) <= 200
    out = P.tokenize(spark, mixed, str(tmp_path)).collect()
    assert len(out) == len(rows) and all(r.n_tokens > 0 for r in out if words(next(x.text for x in rows if x.doc_id == r.doc_id)))


def test_run_gives_what_the_stages_give(spark):
    sf = "/root/testdata/sf0.001"
    a = sorted(map(str, P.run(spark, sf).collect()))
    now = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in P.STAGES:
        now = materialize(stage(spark, now, sf), f"t-{name}")
    assert a == sorted(map(str, now.collect())) and a


def test_entry_registers_the_queries():
    import __spark_entry__ as E
    names = [n for n in E.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 11))
    assert "pipeline" in E.queries() and set(E.oracle_sql()) <= set(E.queries())
    assert bpe.default_path().endswith(".tiktoken")
