"""The pipeline as a whole: odd rows, results side by side, its states."""

import collections
import os
import random
import tempfile

import pytest

pytest.importorskip("lodestar.llm.queries")

import corpus_pipeline  # noqa: E402
from lodestar.llm import common, jaccard  # noqa: E402
from lodestar.session import checkpoint_dir  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, host string, `set` long"


def text_of(rng, n=40):
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(n))


def folder(spark, rows, items=("no such words at all here",)):
    base = tempfile.mkdtemp(prefix="lodestar-pipeline-")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    return base


def row(i, t, source="s"):
    return (i, t, "en", source, 1, "r", "h", 5)


def states(spark):
    base = checkpoint_dir(spark).replace("file:", "") + "/llm-state"
    return set(os.listdir(base)) if os.path.isdir(base) else set()


def test_odd_rows_pass_through(spark):
    rng = random.Random(1)
    a, b, c, d, leak = (text_of(rng) for _ in range(5))
    near = a.split()
    near[3] = "changed"
    rows = [row(1, a), row(2, a), row(3, " ".join(near + ["tail"] * 0)), row(None, b), row(None, b), row(7, c), row(7, c), row(7, d),
            row(8, "x " + leak + " y"), row(9, None), row(10, ""), row(11, "few words only"), row(None, None),
            row(12, text_of(rng, 3000)), row(13, "mail me at a.b@c.org " + text_of(rng))]
    base = folder(spark, rows, items=(leak,))
    before = states(spark)
    out = corpus_pipeline.run(spark, base)
    kept = out.collect()
    left = states(spark) - before
    assert len(left) <= 1  # the packed pieces
    got = collections.Counter(r.doc_id for r in kept if r.piece == 0)
    # a and b once each; of the rows of id 7 one of c and one of d
    assert got == {1: 1, None: 1, 7: 2, 12: 1, 13: 1}
    for k, rows_ in collections.Counter(r.sequence_id for r in kept).items():
        own = sorted((r.offset, r.length) for r in kept if r.sequence_id == k)
        assert own[0][0] == 0 and all(x[0] + x[1] == y[0] for x, y in zip(own, own[1:])) and sum(x[1] for x in own) <= 2048


def test_empty_table(spark):
    assert corpus_pipeline.run(spark, folder(spark, [])).count() == 0


def test_results_side_by_side(spark):
    rng = random.Random(2)
    base = folder(spark, [row(i, text_of(rng, 30)) for i in range(20)])
    docs = spark.read.parquet(f"{base}/documents.parquet")
    first, second = corpus_pipeline.run(spark, base), corpus_pipeline.run(spark, base)
    assert sorted(first.select("doc_id", "ids_crc32").collect()) == sorted(second.select("doc_id", "ids_crc32").collect())
    a = corpus_pipeline.packed(spark, docs, base)
    b = corpus_pipeline.packed(spark, docs.limit(5), base)
    assert (b.count(), a.count(), first.count()) == (5, 20, 20)


@pytest.mark.parametrize("parts", [1, 4])
def test_one_row_of_each_group(spark, parts):
    """Against a plain search over all pairs."""
    rng = random.Random(parts)
    base = [text_of(rng, 30).split() for _ in range(6)]
    rows = []
    for _ in range(60):
        w = list(rng.choice(base))
        if rng.random() < 0.5:
            w[rng.randrange(len(w))] = "new"
        rows.append((rng.choice([None, 1, 2, 3, 4, 50 + len(rows), 100 + len(rows)]), rng.choice([" ".join(w), "  ".join(w), None, ""])))
    sets = []
    for _, t in rows:
        w = (t or "").split()
        sets.append({tuple(w[j:j + 5]) for j in range(len(w) - 4)})
    group = list(range(len(rows)))
    for x in range(len(rows)):
        for y in range(x):
            if sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y]):
                group = [group[x] if g == group[y] else g for g in group]
    want = collections.Counter()
    by_group = collections.defaultdict(list)
    for (i, t), s, g in zip(rows, sets, group):
        if s:
            by_group[g].append(i)
        else:
            want[i] += 1
    for ids in by_group.values():
        known = [i for i in ids if i is not None]
        want[min(known) if known else None] += 1
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, `set` string").repartition(parts)
    got = jaccard.drop_copies(common.write_state(docs)[0])
    assert got.columns == docs.columns
    assert collections.Counter(r.doc_id for r in got.collect()) == want
