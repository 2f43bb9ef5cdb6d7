import random
import re

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from transitlens.llm import decontaminate, mixing, toxicity  # noqa: E402
from transitlens.llm.common import table  # noqa: E402

from .test_decontaminate import best_distance  # noqa: E402
from .test_jaccard_join import brute as components  # noqa: E402
from .test_mixing import draw  # noqa: E402


@pytest.fixture
def small(spark, tmp_path, words):
    """A folder of small tables with copies, near copies, leaks and toxic texts."""
    r = random.Random(13)
    items = [(i, " ".join(words(25))) for i in range(6)]
    rows, labels = [], []
    for i in range(500):
        w = words(40)
        toxic = int(r.random() < 0.2)
        if toxic:
            for b in r.sample(["idiot", "moron", "scum", "loser"], 3):
                w.insert(r.randrange(40), b)
        rows.append((i, " ".join(w), "en", f"src{r.choice([0, 0, 1, 7, 8])}", 1))
        labels.append((i, 1, toxic))
    for i in range(500, 560):
        _, t, lang, _, _ = rows[i - 300]
        w = t.split()
        if i % 3 == 0:
            w[20] = "changed"
        elif i % 3 == 1:
            t = "  ".join(w)
        rows.append((i, " ".join(w) if i % 3 == 0 else t, lang, "src0", 1))
    for i in range(560, 580):
        rows.append((i, " ".join(words(20)) + " " + items[i % 6][1] + " " + " ".join(words(15)), "en", "src9", 1))
    rows += [(580, None, None, None, None), (581, "", "en", "src1", 0)]
    d = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d, rows, items


def test_run_equals_stage_by_stage_brute_force(spark, small):
    d, rows, items = small
    model = toxicity.train(table(spark, d, "documents"), table(spark, d, "labels"))
    score = toxicity.scorer(model)
    left = [x for x in rows if score(x[1]) < toxicity.THRESHOLD]
    assert 60 < len(rows) - len(left) < 160
    first = {}
    for x in left:
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", x[1] or ""), x)
    left = list(first.values())
    stays = {i for i, n, c in components([x[:2] for x in left]) if not n or i == c}
    left = [x for x in left if str(x[0]) in stays]
    norm = [(decontaminate.normalised(t), len(decontaminate.normalised(t)) * decontaminate.EDIT_SHARE) for _, t in items]
    left = [x for x in left if x[0] < 560 or all(best_distance(t, decontaminate.normalised(x[1])) > most for t, most in norm)]
    assert not any(560 <= x[0] < 580 for x in left)
    weights = mixing.TARGET_WEIGHTS
    bucket = lambda s: s if s in weights and s != "*" else "*"
    counts = {}
    for x in left:
        counts[bucket(x[3])] = counts.get(bucket(x[3]), 0) + 1
    present = sum(weights[b] for b in counts)
    want = {}
    for x in left:
        b = bucket(x[3])
        n = draw(weights[b] / present * len(left) / counts[b], str(x[0]), mixing.SEED)
        if n:
            want[x[0]] = n
    got = {}
    out = corpus_pipeline.run(spark, d)
    for r in out.collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
    assert got == want
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", *mixing.ADDED]


def test_stages_but_the_last_keep_the_columns(spark, small):
    d, _, _ = small
    docs = table(spark, d, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(50), d).columns == docs.columns
