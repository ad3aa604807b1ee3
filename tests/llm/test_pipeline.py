"""The pipeline, stage by stage, against brute force; registration."""
import __spark_entry__ as entry
import brute
import public_tokenizers as public
import pytest

import corpus_pipeline
from lotwise.llm import sentencepiece_unigram
from lotwise.llm.oracles import ORACLE
from lotwise.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = entry.queries()
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 11)}
    assert {*QUERIES, "pipeline"} <= set(names)
    assert set(ORACLE) <= set(QUERIES)
    assert set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_match_their_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    want = con.execute(ORACLE[name])
    columns = [c[0] for c in want.description]
    out = QUERIES[name](spark, SF)
    assert sorted(out.columns) == sorted(columns)
    got = sorted(map(tuple, out.select(*columns).collect()), key=repr)
    assert got == sorted(want.fetchall(), key=repr)


def rows_of(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_stages_do_what_brute_force_does(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    benchmark = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet")
                 .select("item_id", "text").collect()]
    extra = [(-1, None, None, "s", 0), (-2, "12 34 ++", None, None, None),
             (-3, "Long " + benchmark[0][1].upper(), "en", "s", 1)]
    path = str(tmp_path / "0")
    docs.union(spark.createDataFrame(extra, docs.schema)).write.parquet(path)
    docs = spark.read.parquet(path)

    def keeps_language(rows):
        return {i for i, t in rows.items() if any(c.isalpha() for c in t or "")}

    def keeps_exact(rows):
        return {k for k, _ in brute.exact(list(rows.items())).values()}

    def keeps_near(rows):
        return set(brute.near(list(rows.items()), 5).values())

    def keeps_clean(rows):
        found = brute.hits(list(rows.items()), benchmark)
        return {i for i, (n, at, _) in found.items() if not (at and 20 * len(at) >= n)}

    for number, keeps in enumerate((keeps_language, keeps_exact, keeps_near, keeps_clean), 1):
        before = rows_of(docs)
        out = corpus_pipeline.STAGES[number - 1][1](spark, docs, SF)
        assert out.columns == columns
        path = str(tmp_path / str(number))
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        assert set(rows_of(docs)) == keeps(before), corpus_pipeline.STAGES[number - 1][0]
    assert -2 not in rows_of(docs) and -3 not in rows_of(docs)

    left = rows_of(docs)
    coded = corpus_pipeline.STAGES[4][1](spark, docs, SF).collect()
    codec = sentencepiece_unigram.UnigramCodec(
        sentencepiece_unigram.Pieces.from_file(public.path(corpus_pipeline.PIECE_FILE)))
    assert {r.doc_id for r in coded} == set(left)
    assert all(r.round_trip and codec.decode(r.piece_ids) == left[r.doc_id] for r in coded)


def test_the_language_model_decides(spark, store):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    clean = docs.where("length(text) > 200").limit(20).selectExpr(
        "-100 - doc_id as doc_id", "concat('Von: ', text) as text", "null as lang", "source", "n_chars")
    junk = [(-1, "zxqj vkwp qzzx jjkq wvvx qqpz xkcd " * 5, None, "s", 0),
            (-2, "Это русский текст о погоде", None, "s", 0),
            (-3, "12 34", "en", "s", 0), (-4, "Ja.", None, "s", 0)]
    rows = docs.union(clean).union(spark.createDataFrame(junk, docs.schema)).collect()
    table = store(spark, rows, docs.schema)
    left = rows_of(corpus_pipeline.identify_language(spark, table, SF))
    assert {r.doc_id for r in rows} - set(left) == {-1, -2, -3}
    unlabelled = store(spark, [(*r[:2], None, *r[3:]) for r in rows], docs.schema)
    left = rows_of(corpus_pipeline.identify_language(spark, unlabelled, SF))
    assert {r.doc_id for r in rows} - set(left) == {-3}


def test_run_chains_the_stages(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "lang", "source", "piece_ids", "n_pieces", "round_trip"]
    assert 0 < out.count() < spark.read.parquet(f"{SF}/documents.parquet").count()
