import difflib
import re
from collections import Counter

from terrane.llm import licenses


def plain(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(
        c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    places = [(i, label) for phrase, label in licenses.PHRASES.items()
              for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()]
    return len(words), sorted(places)


def test_odd_rows_against_plain_search(spark, odd_docs, no_docs):
    extra = ["mit mit license MIT LICENSE", "the cc by", "Cc/By ccéby", "K mit license",
             "apache  license, version 2.0 - licensed under the apache License", "gnu general public"]
    docs = odd_docs.select("doc_id", "text").union(spark.createDataFrame(
        [(100 + i, x) for i, x in enumerate(extra)], "doc_id long, text string"))
    docs = docs.withColumn("at", docs.doc_id).withColumn("label", docs.text)
    got = sorted(map(repr, ((r["doc_id"], r["n_words"], r["n_base"], r["first_word"],
                             r["last_word"], r["base_labels"]) for r in
                            licenses.labels(docs).collect())))
    want = []
    for r in docs.collect():
        n, places = plain(r["text"])
        want.append(repr((r["doc_id"], n, len(places), min(places)[0] if places else None,
                          max(places)[0] if places else None,
                          ",".join(sorted({x for _, x in places})))))
    assert got == sorted(want)
    assert licenses.labels(no_docs).count() == 0


def holds(words, notice):
    """Whether a window of the words has the notice's words in order, four fifths of them at
    least, and the last of them or, for a variant of a licence, its own words next to each
    other; by trying every window, without votes or diagonals."""
    need = notice.split()
    size = len(need) + 4
    for i, w in enumerate(words):
        if w in need[:3]:
            window = words[i:i + size]
            blocks = difflib.SequenceMatcher(None, window, need, False).get_matching_blocks()
            if sum(b.size for b in blocks) >= 0.8 * len(need):
                return True
    return False


#: For the notices that resemble others, the words that only they have.
OWN = {"gpl-2.0": "version 2", "gpl-3.0": "version 3", "cc-by-4.0": "by 4 0",
       "cc-by-nc-4.0": "by nc 4", "cc-by-sa-4.0": "by sa 4", "apache-2.0": "apache license"}


def test_whole_table_has_no_label_without_its_own_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    got = {r["doc_id"]: set(filter(None, r["labels"].split(",")))
           for r in licenses.labels(docs).collect()}
    by_label = {label: notice for notice, label in licenses.NOTICES.items()}
    seen = Counter()
    for r in docs.collect():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (r["text"] or "").lower())
        text = f" {' '.join(words)} "
        if not got[r["doc_id"]] and "licen" not in text:
            continue
        for label, own in OWN.items():
            if label in got[r["doc_id"]]:
                seen[label] += 1
                assert f" {own} " in text and holds(words, by_label[label])
            elif f" {by_label[label]} " in text:
                raise AssertionError((r["doc_id"], label))
    assert seen["gpl-3.0"] > 50 and seen["cc-by-nc-4.0"] > 50
    assert not seen["gpl-2.0"] and not seen["cc-by-4.0"]


def test_variants_are_told_apart(spark):
    texts = {
        1: "this work is licensed under the gnu general public license version 2 only",
        2: "This Work is licensed under the GNU General Public License, version 3.",
        3: "licensed under CC BY 4.0", 4: "licensed under CC BY-NC 4.0",
        5: "licensed under CC-BY-SA 4.0 and licensed under CC-BY 4.0",
        6: "licensed under the apache license version 1.1",
        7: "licensed under the apache software license version 2.0",
        8: "gnu lesser general public license", 9: "gnu general public license",
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["labels"].split(",") for r in licenses.labels(docs).collect()}
    own = {i: sorted(x for x in v if x and "-" in x and x != "cc-by" or x in ("lgpl", "agpl"))
           for i, v in got.items()}
    assert own == {1: ["gpl-2.0"], 2: ["gpl-3.0"], 3: ["cc-by-4.0"], 4: ["cc-by-nc-4.0"],
                   5: ["cc-by-4.0", "cc-by-sa-4.0"], 6: [], 7: [], 8: ["lgpl"], 9: []}


def test_a_notice_with_changes_is_found(spark):
    notice = next(x for x, label in licenses.NOTICES.items() if label == "bsd-text").split()
    changed = [*"some words before".split(), *notice[:8], "new", *notice[8:], "after"]
    docs = spark.createDataFrame([(1, " ".join(changed)), (2, " ".join(notice[:6]))],
                                 "doc_id long, text string")
    rows = {r["doc_id"]: r for r in licenses.labels(docs).collect()}
    assert rows[1]["labels"] == "bsd-text" and rows[1]["score"] > 0.8
    assert rows[2]["labels"] == "" and rows[2]["score"] == 0.0
    span = licenses.spans(docs).where("label = 'bsd-text'").first()
    assert span["first_word"] == 3 and span["last_word"] == len(changed) - 2
