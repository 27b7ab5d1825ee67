"""The registered queries: against SQL where SQL has them, and the pipeline against plain loops."""

import duckdb
import pytest
from llm_rows import ODD, prose
from test_native import expected_lines
from test_search import brute_contamination, brute_near

import corpus_pipeline
from aerostat.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    names = sorted(df.columns)
    want = con.sql(ORACLES[name])
    assert sorted(want.columns) == names
    rows = sorted(want.select(*[f'"{n}"' for n in names]).fetchall(), key=str)
    assert sorted((tuple(r) for r in df.select(*names).collect()), key=str) == rows


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"op11_spelling"}))  # that one has a row per word
def test_query_covers_its_table(spark, name):
    source, key = ("pages", "page_id") if name.startswith("op7") else ("documents", "doc_id")
    ids = sorted(r[0] for r in spark.read.parquet(f"{SF}/{source}.parquet").select(key).collect())
    assert sorted(r[0] for r in QUERIES[name](spark, SF).select(key).collect()) == ids


def write(spark, tmp_path, rows, items):
    docs = spark.createDataFrame(
        [(k, t, "en", "s", None if t is None else len(t)) for k, t in rows],
        "doc_id bigint, text string, lang string, source string, n_chars bigint",
    )
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return docs


def plain(rows, items):
    """The first four stages, with loops over all pairs."""
    rows = [(k, t) for k, t in rows if any(c.isalpha() for c in t or "")]
    gone = expected_lines(rows)
    cut = []
    for k, t in rows:
        lines = [line for n, line in enumerate(t.split("\n")) if n not in gone.get(k, [])]
        t = "\n".join(lines) if k in gone else t
        if k not in gone or t.strip():
            cut.append((k, t))
    rows = [r for r, v in zip(sorted(cut, key=str), brute_near(sorted(cut, key=str))) if v[0] == v[4]]
    out = []
    for k, t in rows:
        n, hit, _ = brute_contamination(t, items, 13)
        if not (hit and 20 * hit >= n):
            out.append((k, t))
    return sorted(out)


def test_pipeline_against_loops(spark, tmp_path):
    items = [(1, prose(500, 30)), (2, "short item")]
    rows = [(i, "\n".join(prose(10 * i + j, 25) for j in range(3))) for i in range(1, 25)]
    rows += [(30, rows[0][1]), (31, rows[1][1] + "\nnew line at the end"), (32, prose(500, 30)), (33, prose(7, 400) + "\n" + prose(500, 14))]
    rows += [(34, prose(777, 60)), (35, prose(777, 60).replace(" ", "  ") + " more"), (36, None), (37, ""), (38, "12 34"), (39, "a short item")]
    write(spark, tmp_path, rows, items)
    out = corpus_pipeline.run(spark, str(tmp_path))
    got = sorted((r["doc_id"], r["round_trip"], r["n_tokens"] == len(r["ids"])) for r in out.collect())
    assert got == [(k, True, True) for k, _ in plain(rows, items)]


def test_stages_keep_the_columns_and_clashing_ones(spark, table, tmp_path):
    write(spark, tmp_path, [(1, "x")], [(1, prose(1, 20))])
    docs = table(ODD)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name != "sentencepiece":
            assert out.columns == docs.columns
        else:
            assert {"ids", "n_tokens", "round_trip"} < set(out.columns)
        assert len(out.collect()) > 0
        assert stage(spark, docs.filter("false"), str(tmp_path)).collect() == []


def test_clashing_columns_keep_their_values(spark):
    rows = [(1, "one two three\nfour five six", 777, "mine"), (2, "one two three\nseven eight nine", 778, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_lines int, removed string")
    out = corpus_pipeline.drop_repeated_lines(spark, docs, SF)
    assert out.schema == docs.schema
    assert sorted(map(tuple, out.collect())) == [rows[0], (2, "seven eight nine", 778, None)]


def test_near_copies_without_an_id_or_with_a_shared_one(spark, table):
    text, other = prose(1, 40), prose(2, 40)
    near = text + " and"
    rows = [(5, text), (None, near), (None, near), (None, other), (7, other + " or"), (7, text + " but"), (7, prose(3, 40))]
    rows += [(8, prose(4, 40)), (8, prose(4, 40)), (None, None), (None, None), (9, ""), (9, "")]
    stay = corpus_pipeline.drop_near_copies(spark, table(rows), SF)
    want = [(5, text), (7, other + " or"), (7, prose(3, 40)), (8, prose(4, 40)), (None, None), (None, None), (9, ""), (9, "")]
    assert sorted(map(str, stay.select("doc_id", "text").toLocalIterator())) == sorted(
        map(str, table(want).select("doc_id", "text").toLocalIterator())
    )


def test_stages_are_those_that_were_asked_for():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "jaccard_join", "decontamination", "sentencepiece"]
