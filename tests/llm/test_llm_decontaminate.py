import random
import re

from calipers.llm import decontaminate
from corpus_cases import documents, empty

WORD = re.compile(decontaminate.FOLDED_WORD)


def words(text):
    return WORD.findall((text or "").translate(decontaminate.FOLD))


def brute(docs, items, n=10):
    grams = {}
    for i, t in items:
        w = words(t)
        size = min(n, len(w))
        for k in range(len(w) - size + 1 if size else 0):
            grams.setdefault(tuple(w[k : k + size]), set()).add("null" if i is None else str(i))
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for k in range(len(w)):
            for size in range(1, n + 1):
                if tuple(w[k : k + size]) in grams and k + size <= len(w):
                    hit.update(range(k, k + size))
                    found |= grams[tuple(w[k : k + size])]
        out.append((i, len(w), sorted(hit), sorted(found)))
    return sorted(out, key=str)


def test_against_brute_force_in_one_block_and_in_many(spark):
    random.seed(1)
    draw = lambda n: " ".join(random.choice(["a", "B", "c", "É"]) for _ in range(n))
    items = [(k, draw(random.choice([1, 3, 6, 7, 9]))) for k in range(9)] + [(None, "x y"), (3, ""), (4, None), (10, "x y")]
    docs = [(k, draw(random.randint(0, 30)).replace(" ", random.choice([" ", "-", "\n"]))) for k in range(40)] + [(41, None), (42, "q X, y z"), (42, "q X, y z")]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for most in (1000, 8):
        got = decontaminate.search(d, b, n=6, most=most).select("row.doc_id", "n_words", "hits", "items").collect()
        assert sorted(map(tuple, got), key=str) == brute(docs, items, 6)


def test_spans_leave_the_rest_of_the_text(spark):
    d = spark.createDataFrame([(1, "Keep, this. ONE two; three! and that."), (2, "one two"), (3, None), (4, "clean one")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "one two three"), (2, "Two Three")], "item_id long, text string")
    got = {r["doc_id"]: r["text"] for r in decontaminate.spans_removed(decontaminate.search(d, b, n=3)).select("row.doc_id", "text").collect()}
    assert got == {1: "Keep, this. ! and that.", 2: "one two", 3: None, 4: "clean one"}


def test_cases(spark):
    b = spark.createDataFrame([(1, "jumps over the lazy dog"), (2, None)], "item_id long, text string")
    got = decontaminate.search(documents(spark), b).collect()
    assert len(got) == 9 and sorted(len(r["hits"]) for r in got)[-3:] == [0, 10, 10]
    assert decontaminate.search(empty(spark), b).count() == 0
    assert decontaminate.search(documents(spark), b.filter("false")).filter("size(hits) > 0").count() == 0
