import os
import subprocess
import sys

import public_tokenizers
from helpers import roots
from test_exact_dedup import brute
from test_packing import check
from test_simhash import near, plain_fingerprint
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from hourgrid.llm import decontaminate, quality, queries

ROOT = os.path.dirname(os.path.abspath(entry.__file__))


def test_stages_against_brute_force(spark, tmp_path):
    """Each stage on all that the one before it kept."""
    sf_dir = "/root/testdata/sf0.01"
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    docs, columns = read("documents"), read("documents").columns
    model = quality.train(docs, read("labels").where(f"NOT ({queries.HELD_OUT})"))
    items = [r.text for r in read("benchmark").collect()]
    have = sorted((r.doc_id, r.text) for r in docs.collect())
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name == "quality":
            scores = model.score(quality.np.array([quality.statistics(t) for _, t in have]))
            want = [d for d, s in zip(have, scores) if s >= 0.3]
        elif name == "exact_dedup":
            stay = {i for i, *_, kept, _ in brute(have) if kept}
            want = [d for d in have if d[0] in stay]
        elif name == "simhash":
            prints = {i: plain_fingerprint(t) for i, t in have}
            root, first = roots(near(sorted(set(prints.values())))), {}
            for i, p in prints.items():
                first.setdefault(root.get(p, p), i)
            want = [d for d in have if d[0] in set(first.values())]
        elif name == "decontaminate":
            bags = [(decontaminate.words_of(t), decontaminate.bag(decontaminate.words_of(t), 5)) for t in items]

            def holds(text):
                words = decontaminate.words_of(text)
                own = set(zip(*(words[k:] for k in range(5))))
                return any(
                    decontaminate.similarity(decontaminate.bag(words[k : k + len(w)], 5), b) >= 0.8
                    for w, b in bags if own & set(b) for k in range(max(1, len(words) - len(w) + 1))
                )

            want = [d for d in have if not holds(d[1])]
        else:
            check(Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), have, docs.collect())
            return
        assert docs.columns == columns
        got = sorted((r.doc_id, r.text) for r in docs.collect())
        assert got == want and len(got) < len(have)
        have = got


def test_run_on_small_tables(spark, sf_dir):
    got = entry.queries()["pipeline"](spark, sf_dir)
    assert got.columns[:8] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_length"]
    assert 0 < got.select("doc_id").distinct().count() < spark.read.parquet(f"{sf_dir}/documents.parquet").count()


def test_the_operators_and_the_pipeline_are_registered():
    names = list(entry.queries())
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14)) and "pipeline" in names


def test_the_rest_works_without_these_folders(tmp_path):
    for name in os.listdir(ROOT):
        if name not in ("corpus_pipeline.py", "hourgrid", ".git"):
            os.symlink(f"{ROOT}/{name}", tmp_path / name)
    os.mkdir(tmp_path / "hourgrid")
    for name in os.listdir(f"{ROOT}/hourgrid"):
        if name != "llm":
            os.symlink(f"{ROOT}/hourgrid/{name}", tmp_path / "hourgrid" / name)
    code = "import sys; sys.path.insert(0, '.'); import importlib.util as u; s = u.spec_from_file_location('e', '__spark_entry__.py'); m = u.module_from_spec(s); s.loader.exec_module(m); print(len(m.queries()), any(k.startswith('op1') for k in m.queries()))"
    text = open(f"{ROOT}/__spark_entry__.py").read().replace("os.path.dirname(os.path.abspath(__file__))", repr(str(tmp_path)))
    os.unlink(tmp_path / "__spark_entry__.py")
    (tmp_path / "__spark_entry__.py").write_text(text)
    env = {**os.environ, "PYTHONDONTWRITEBYTECODE": "1", "PYTHONPATH": str(tmp_path)}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    n, there = done.stdout.split() if done.stdout else (0, done.stderr)
    assert int(n) > 100 and there == "False", done.stderr
