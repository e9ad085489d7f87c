import hashlib
import random

import pytest

from terrane.llm import chunks

MASK32, MASK64 = (1 << 32) - 1, (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15


def plain_hashes(data):
    """The rolling hash at every byte from the seventh on, one window at a time."""
    for end in range(7, len(data) + 1):
        h = 0
        for b in data[end - 7:end]:
            h = (h * 0x01000193 + b) & MASK32
        h ^= h >> 15
        yield end, ((h * 0x9E3779B1) & MASK32) >> 8


def plain_symbols(data, ends):
    out, start = [], 0
    for end in [*[e for e in ends if e < len(data)], len(data)]:
        if end > start or not ends:
            h = 0
            for b in reversed(data[start:end]):
                h = (h * BASE + b + 1) & MASK64
            h ^= h >> 32
            out.append(chunks.SYMBOLS[(h * BASE & MASK64) >> 52])
            start = end
    return "".join(out) if data else ""


def plain_fingerprint(text):
    data = text.encode()
    hashes = list(plain_hashes(data))
    power = 1
    ends = lambda p: [e for e, h in hashes if p <= 24 and h % (1 << p) == 0]
    while len(ends(power)) >= 64:
        power += 1
    return f"{power}:{plain_symbols(data, ends(power))}:{plain_symbols(data, ends(power + 1))}"


def sentence(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefgé", k=rng.randint(1, 7))) for _ in range(n))


@pytest.mark.parametrize("n", [0, 1, 2, 5, 30, 300, 3000])
def test_fingerprint_by_definition(n):
    text = sentence(n, n)
    assert chunks.fingerprint(text) == plain_fingerprint(text)


def test_long_and_uniform_texts(monkeypatch):
    monkeypatch.setattr(chunks, "SEGMENT", 1000)
    monkeypatch.setattr(chunks, "_POWERS", chunks._POWERS[:1000])
    monkeypatch.setattr(chunks, "_BACKS", chunks._BACKS[:1000])
    for text in (sentence(9, 2000), "a" * 5000, "ab" * 2500 + sentence(1, 40), "\x00" * 2003):
        assert chunks.fingerprint(text) == plain_fingerprint(text)


def plain_distance(a, b):
    """Edit distance without replacement, by the table of all prefixes."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(last[j - 1] if x == y else 1 + min(last[j], row[j - 1]))
    return row[-1]


def test_edit_distance():
    rng = random.Random(4)
    for _ in range(300):
        a, b = (rng.choices("abc", k=rng.randint(0, 9)) for _ in range(2))
        common = chunks.common_length(a, b)
        assert len(a) + len(b) - 2 * common == plain_distance(a, b)


def test_likeness():
    text = sentence(3, 800)
    mark = chunks.fingerprint(text)
    assert chunks.likeness(mark, mark) == 1.0
    changed = text[:2000] + "XX" + text[2003:]
    assert 0.9 < chunks.likeness(mark, chunks.fingerprint(changed)) < 1
    assert chunks.likeness(mark, chunks.fingerprint("q" * 40 + text)) > 0.9  # all is moved
    assert chunks.likeness(mark, chunks.fingerprint(sentence(4, 800))) < 0.3
    # twice the text has twice the block size, at which the halves are still found
    assert chunks.likeness(mark, chunks.fingerprint(text + sentence(5, 800))) > 0.3
    assert chunks.likeness(mark, chunks.fingerprint("short")) == 0
    assert chunks.likeness(chunks.fingerprint(""), chunks.fingerprint("")) == 1
    assert chunks.likeness(chunks.fingerprint(""), chunks.fingerprint("abc")) == 0


def brute(docs):
    """Rows by the sorted list of different documents; ties by hash are by text here."""
    key = lambda d: (d[0] is not None, d[0] or 0, d[2], d[1])
    order = sorted(set(docs), key=key)
    out = []
    for d in docs:
        after = order[(order.index(d) + 1) % len(order)][1]
        text = d[1]
        cut = len(text) - len(text) // 4
        edited = text[:cut] + after[:len(text) - cut]
        own, mark, following = map(plain_fingerprint, (text, edited, after))
        out.append((d[0], len(text), hashlib.sha256(edited.encode()).hexdigest(), own, mark,
                    chunks.likeness(own, mark), chunks.likeness(own, following)))
    return sorted(out, key=str)


def with_hash(spark, df):
    rows = df.selectExpr("doc_id", "coalesce(text, '') AS text", "xxhash64(coalesce(text, '')) AS h")
    return [(r.doc_id, r.text, r.h) for r in rows.collect()]


def test_compared_against_brute_force(spark, odd_docs):
    short = odd_docs.where("length(coalesce(text, '')) < 3000")
    more = short.limit(0)
    for i in (-5, None, None, 7):
        more = more.unionByName(odd_docs.where("doc_id = 3").selectExpr(
            f"cast({'null' if i is None else i} as long) AS doc_id",
            *[c for c in odd_docs.columns if c != "doc_id"]))
    docs = short.unionByName(more).repartition(5)
    got = sorted(map(tuple, chunks.compared(docs).collect()), key=str)
    assert got == brute(with_hash(spark, docs))


def test_single_document_follows_itself(spark):
    one = spark.createDataFrame([(4, "abcdefgh"), (4, "abcdefgh")], "doc_id long, text string")
    rows = chunks.compared(one).collect()
    assert len(rows) == 2 and rows[0] == rows[1] and rows[0].n_chars == 8
    assert rows[0].edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()
    assert rows[0].near_next == 1.0


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = {r.doc_id: r for r in chunks.compared(docs).collect()}
    texts = sorted((r.doc_id, r.text or "") for r in docs.collect())
    assert len(rows) == len(texts)
    for (i, text), (_, after) in zip(texts, [*texts[1:], texts[0]]):
        cut = len(text) - len(text) // 4
        edited = text[:cut] + after[:len(text) - cut]
        r = rows[i]
        assert (r.n_chars, r.edited_sha256) == (
            len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.fingerprint == chunks.fingerprint(text)
        assert r.edited_fingerprint == chunks.fingerprint(edited)
    known = [r for r in rows.values() if r.n_chars >= 400]
    assert sum(r.near_edited >= 0.5 for r in known) >= 0.95 * len(known)


def test_fingerprints_and_likenesses(spark, odd_docs, no_docs):
    made = chunks.fingerprints(odd_docs)
    assert made.columns == [*odd_docs.columns, "fingerprint"]
    rows = made.collect()
    assert len(rows) == odd_docs.count()
    assert all(r.fingerprint == chunks.fingerprint(r.text or "") for r in rows)
    pairs = made.selectExpr("fingerprint AS a", "cast(null as string) AS b")
    assert all(r[0] == 1 for r in pairs.select(chunks.likenesses(pairs.a, pairs.a)).collect())
    assert all(r[0] is None for r in pairs.select(chunks.likenesses(pairs.a, pairs.b)).collect())
    with pytest.raises(ValueError):
        chunks.fingerprints(odd_docs, "text")
    assert chunks.fingerprints(no_docs).count() == chunks.compared(no_docs).count() == 0
