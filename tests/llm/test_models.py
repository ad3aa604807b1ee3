"""Language identification and URL filters."""
import numpy as np
import pytest

from lotwise.llm import context_tree, language_id, queries, url_filter
from lotwise.llm.url_filter import Rule


def learnt(texts_by_label, kind="ppm"):
    labels, codes, counts = [], [], []
    for label, texts in texts_by_label.items():
        grams, n = np.unique(context_tree.grams([t.encode() for t in texts])[0],
                             return_counts=True)
        labels += [label] * len(grams)
        codes.append(grams)
        counts.append(n)
    return context_tree.ContextTrees(labels, np.concatenate(codes), np.concatenate(counts), kind)


@pytest.mark.parametrize("kind", ["ppm", "discount"])
def test_each_context_is_a_distribution(kind):
    trees = learnt({"a": ["abracadabra", "banana"], "b": ["xyz xyz", "zebra"]}, kind)
    for context in (0, 0x616272, 0x7A6562, 0x007878, 0x616161, 0xFFFFFF):
        codes = (np.uint32(context) << np.uint32(8)) | np.arange(256, dtype=np.uint32)
        assert np.allclose(np.exp2(-trees.code_lengths(codes).astype(float)).sum(axis=0), 1,
                           atol=1e-3)


def test_code_length_of_method_c():
    """After 'a' in "abac": b and c once each, escape 2 of 4."""
    trees = learnt({"a": ["abac"]})
    code = np.array([ord("a") << 8 | ord("b")], np.uint32)
    assert trees.code_lengths(code, 1)[0, 0] == pytest.approx(2.0)


def test_scores_do_not_depend_on_blocks():
    trees = learnt({"a": ["abc abc"], "b": ["xyz"]})
    texts = [b"abc", b"", b"xyz" * 1000, "é".encode(), b"", b"a"]
    together = np.concatenate(list(trees.score(texts)))
    alone = np.concatenate([next(trees.score([t])) for t in texts])
    assert np.allclose(together, alone)
    assert (together[[1, 4]] == 0).all()


def test_hash_index_finds_all_keys():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 32, 5000, np.uint32))
    index = context_tree.HashIndex(keys)
    assert (index.find(keys) == np.arange(len(keys))).all()
    other = np.setdiff1d(np.arange(10000, dtype=np.uint32), keys)
    assert (index.find(other) == -1).all()


LABELLED = "doc_id long, text string, lang string, score string"


def test_language_id_defined_cases(spark, store):
    english = ["the cat and the dog went home", "this is the house of the king"] * 5
    german = ["der hund und die katze sind da", "das ist das haus des königs"] * 5
    rows = [(i, t, "en", "") for i, t in enumerate(english)]
    rows += [(100 + i, t, "de", "") for i, t in enumerate(german)]
    rows += [(200, None, "en", ""), (201, "", "en", ""), (202, "12 + 3", None, None),
             (203, "the king and the cat", None, ""), (204, "die katze und der könig " * 20000,
                                                       None, "")]
    docs = store(spark, rows, LABELLED)
    out = {r.doc_id: r for r in language_id.predict(docs, language_id.learn(docs)).collect()}
    assert len(out) == len(rows)
    assert {out[i].lang_pred for i in (200, 201, 202)} == {"und"}
    assert {out[i].score for i in (200, 201, 202)} == {0.0}
    assert out[203].lang_pred == "en" and out[204].lang_pred == "de"
    assert all(0 <= r.score <= 1 for r in out.values())
    assert language_id.learn(docs.limit(0)) is None
    none = language_id.predict(docs, None).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}
    assert language_id.predict(docs.limit(0), language_id.learn(docs)).count() == 0


def test_model_budget_keeps_frequent_grams(spark, store):
    docs = store(spark, [(1, "aaaa" * 50 + "".join(map(chr, range(97, 123))), "x", ""),
                         (2, "zzzz", "y", "")], LABELLED)
    model = language_id.learn(docs, max_grams=10)
    assert model.labels == ["x", "y"]
    assert len(model.keys[3]) <= 10


def test_counts_beyond_the_budget_still_count(spark, store):
    """A model that is not broadcast whole codes like one that is."""
    rows = [(i, t and t * (1 + i % 3), lang, "") for i, (t, lang) in enumerate([
        ("the cat and the dog went home", "en"), ("this is the house of the king", "en"),
        ("der hund und die katze sind da", "de"), ("das ist das haus des königs", "de"),
        ("猫は家にいます。犬もいます", "ja"), ("", "ja"), (None, None), ("12 3", None),
        ("the queen sings", None), ("die königin singt", None), ("犬は猫です", None)])]
    docs = store(spark, rows, LABELLED)
    whole = {r.doc_id: r for r in language_id.predict(docs, language_id.learn(docs)).collect()}
    for budget in (1, 12, 100):
        model = language_id.learn(docs, max_grams=budget)
        assert model.labels == ["de", "en", "ja"] and 3 * len(model.keys[3]) <= budget
        out = language_id.predict(docs, model).collect()
        assert len(out) == len(rows) and out[0].asDict().keys() == whole[0].asDict().keys()
        for r in out:
            assert r.lang_pred == whole[r.doc_id].lang_pred
            assert r.score == pytest.approx(whole[r.doc_id].score, abs=1e-5)


def test_url_scores_do_not_depend_on_the_budget(spark, store):
    rows = [(i, f"http://good{i % 7}.org/news/story-{i}") for i in range(60)]
    rows += [(1000 + i, f"http://win{i % 5}.biz/cheap-pills/{i}") for i in range(60)]
    rows += [(5000, "http://other.com/news/story-9"), (5001, None), (5002, "http://猫.jp/é")]
    urls = store(spark, rows, "page_id int, url string")
    rules = [Rule("allow", "org/"), Rule("block", "biz/")]
    whole, split = ({r.page_id: r for r in url_filter.judge(
        urls, rules, url_filter.learn(urls, rules, max_grams=n)).collect()} for n in (1 << 20, 40))
    assert len(split) == len(rows)
    for i, r in whole.items():
        assert split[i].verdict == r.verdict
        assert split[i].url_score == pytest.approx(r.url_score, abs=1e-4)


def test_held_out_accuracy(spark):
    out = queries.op1_language_id(spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    held = out.where("held_out").join(truth.where("lang is not null"), "doc_id").collect()
    assert len(held) > 200
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.97


def test_url_parts_and_rules(spark):
    urls = [("http://A.Example.NET/en/x?q#f", "a.example.net", "/en/x", "example.net/en/", "allow"),
            ("x://b.net/EN/", "b.net", "/EN/", "net/", "block"),
            ("https://example.com/de/1", "example.com", "/de/1", "example.com/de/", "block"),
            ("https://notexample.com/de/1", "notexample.com", "/de/1", None, None),
            ("ftp://org/fr/", "org", "/fr/", "org/fr/", "allow"),
            ("http://x.net", "x.net", "", None, None), ("http://x.net?a/en/", "x.net", "", None, None),
            ("no scheme/net/", "", "", None, None), ("", "", "", None, None),
            (None, "", "", None, None), ("a://b://c.net/", "b:", "//c.net/", None, None)]
    df = spark.createDataFrame([(i, u[0], "h") for i, u in enumerate(urls)],
                               "page_id int, url string, HOST string")
    out = {r.page_id: r for r in url_filter.judge(
        df, queries.URL_RULES, url_filter.UrlModel(None, 0.0)).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(urls):
        assert (out[i].host, out[i].path, out[i].rule) == (host, path, rule)
        assert out[i].verdict == (verdict or "allow")


def test_url_model_learns_the_difference(spark):
    rows = [(i, f"http://good{i % 7}.org/news/story-{i}") for i in range(200)]
    rows += [(1000 + i, f"http://win{i % 5}.biz/cheap-pills/{i}") for i in range(200)]
    rows += [(5000, "http://other.com/news/story-9"), (5001, "http://other.com/cheap-pills/9"),
             (5002, "http://other.com/cheap-pills/" + "9" * 50000), (5003, None), (5004, "x")]
    urls = spark.createDataFrame(rows, "page_id int, url string")
    rules = [Rule("allow", "org/"), Rule("block", "biz/")]
    model = url_filter.learn(urls, rules)
    out = {r.page_id: r.verdict for r in url_filter.judge(urls, rules, model).collect()}
    assert len(out) == len(rows)
    assert out[5000] == "allow" and out[5001] == "block"
    assert url_filter.learn(urls.where("page_id < 1000"), rules).trees is None
    assert url_filter.judge(urls.limit(0), rules, model).count() == 0


def test_equal_error_threshold():
    histogram = [("allow", 10, 9), ("allow", -3, 1), ("block", -5, 8), ("block", 2, 2)]
    edge = url_filter.equal_error_threshold(histogram) * url_filter.BINS_PER_BIT
    assert 2 < edge <= 10
    assert url_filter.equal_error_threshold([("allow", 1, 5)]) == 0.0
