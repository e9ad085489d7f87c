from collections import Counter, defaultdict
from itertools import combinations

import pytest

import __spark_entry__ as spec
import corpus_pipeline as pipeline
from terrane.llm import quality, toxicity

SF = "/root/testdata/sf0.01"


def test_registered():
    names = set(spec.queries())
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1


def check_near_copies(rows, kept):
    """All pairs of 5-word shingle sets that share a shingle, held against what was kept."""
    def shingles(text):
        words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
        return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    sets = {i: shingles(text) for i, text in rows}
    holders = defaultdict(list)
    for i in sorted(sets):
        for shingle in sets[i]:
            holders[shingle].append(i)
    shared = Counter(p for ids in holders.values() for p in combinations(ids, 2))
    near = [p for p, n in shared.items()
            if n >= 0.8 * (len(sets[p[0]]) + len(sets[p[1]]) - n)]
    later = {b for _, b in near}
    lost = set(sets) - kept
    empty = sorted(i for i in sets if not sets[i])
    assert lost <= later | set(empty[1:])
    assert len(later & kept) <= 0.1 * len(later)
    assert len(set(empty) & kept) == min(1, len(empty))


def test_stages_do_what_their_models_say(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = pipeline.clean(spark, docs, SF)
    toxic = toxicity.score(docs, toxicity.fit(docs, labels)).where("rejected")
    assert kept.columns == columns
    assert {r[0] for r in kept.select("doc_id").collect()} == {
        r[0] for r in docs.select("doc_id").collect()} - {
        r[0] for r in toxic.select("doc_id").collect()}
    fair = pipeline.good(spark, kept, SF)
    bad = quality.score(kept, quality.fit(kept, labels)).where("predicted = 0")
    assert fair.columns == columns and fair.count() == kept.count() - bad.count()
    one = pipeline.distinct(spark, fair, SF)
    assert one.columns == columns
    check_near_copies([tuple(r) for r in fair.select("doc_id", "text").collect()],
                      {r[0] for r in one.select("doc_id").collect()})
    mix = pipeline.mixed(spark, one, SF)
    assert mix.columns == columns
    last = pipeline.encoded(spark, mix, SF)
    assert last.count() == mix.count() and last.where("not decodes").count() == 0
    assert last.where("length(ids) != 4 * n_tokens").count() == 0


@pytest.mark.parametrize("empty", [False, True])
def test_odd_rows_pass_all_stages(spark, odd_docs, no_docs, empty):
    docs = no_docs if empty else odd_docs
    columns = docs.columns
    for _, stage in pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF)
        assert docs.count() <= 2 * before.count()
        if stage is not pipeline.encoded:
            assert docs.columns == columns


def test_run(spark):
    assert pipeline.run(spark, "/root/testdata/sf0.001").count() > 0
