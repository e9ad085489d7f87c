import random

from terrane.llm import toxicity


def similar(a, b):
    a, b = ({tuple(p) for p in zip(x.split(), x.split()[1:], strict=False)} for x in (a, b))
    return len(a & b) / len(a | b)


def kept(spark, rows, monkeypatch):
    """Ids of the rows that teach."""
    seen = []
    real = toxicity.without_copies
    monkeypatch.setattr(toxicity, "without_copies", lambda x: seen.append(real(x)) or seen[0])
    docs = spark.createDataFrame([(i, text) for i, text, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    toxicity.fit(docs, labels)
    return {r["doc_id"] for r in seen[0].select("doc_id").collect()}


def test_only_verified_copies_are_dropped(spark, monkeypatch):
    rng = random.Random(3)
    # short texts that all share many pairs: far below the similarity, yet with equal min-hashes
    base = "one two three four five six seven eight nine ten".split()
    rows = [(i, " ".join(base + [f"w{rng.randrange(10 ** 6)}" for _ in range(20)]), i % 2)
            for i in range(40)]
    long = [f"v{i}" for i in range(60)]
    rows += [(100, " ".join(long), 0), (101, " ".join([*long[:-1], "end"]), 0),
             (102, " ".join(long), 1), (103, " ".join(long), 0)]
    assert similar(rows[0][1], rows[2][1]) < 0.5 and similar(rows[40][1], rows[41][1]) > 0.9
    assert kept(spark, rows, monkeypatch) == set(range(40)) | {100, 102}


def test_dropped_rows_are_like_one_that_stays(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = [(r["doc_id"], " ".join(toxicity.TOKEN.findall((r["text"] or "").lower())),
             int(r["toxic"])) for r in docs.join(labels, "doc_id").where(
        "doc_id is not null and toxic is not null").select("doc_id", "text", "toxic").collect()]
    stay = kept(spark, rows, monkeypatch)
    for i, text, y in rows:
        if i not in stay:
            assert any(similar(text, t) >= 0.8 for j, t, z in rows if j in stay and z == y)
