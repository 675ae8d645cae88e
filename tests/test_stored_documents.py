"""Documents stored as VARIANT: same rows as from text, no text read, shredded files."""

import json

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from marketlens.functions import jsonops as J
from marketlens.operators import quality as Qa
from marketlens.plans import queries as Q
from marketlens.plans import views as V
from marketlens.sources import warehouse as W

#: Keys whose JSON comes from a stored VARIANT, and that column.
STORED = {"json_paths": "props", "json_contains": "props", "json_has_key": "business_doc", "json_any_all_keys": "business_doc",
          "generated_columns": "business_doc", "market_leaders": "business_doc", "business_summary": "business_doc",
          "biz_with_instagram": "business_doc", "influencer_potential": "business_doc", "social_gap": "business_doc", "inc_score": "business_doc"}
#: Of these, the keys that name single fields, and so read no whole document.
FIELDS = sorted(set(STORED) - {"json_contains", "social_gap"})


@pytest.fixture(autouse=True)
def whole_schemas(spark):
    """Scans print their whole schema."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _scan(plan, column):
    """The ReadSchema lines of the scans that read the column."""
    found = [line.split("ReadSchema: ", 1)[1] for line in plan.splitlines() if "ReadSchema: " in line and column + ":" in line.split("ReadSchema: ", 1)[1]]
    assert found, plan
    return found


@pytest.mark.parametrize("key", sorted(STORED))
def test_no_json_text_is_read(spark, sf_dir, key):
    plan = _plan(E.queries()[key](spark, sf_dir))
    assert not any(f in plan for f in ("get_json_object", "from_json", "json_object_keys", "parse_json"))
    assert "business_data" not in plan and "props:string" not in plan


@pytest.mark.parametrize("key", FIELDS)
def test_scans_read_only_the_fields_that_a_query_names(spark, sf_dir, key):
    for schema in _scan(_plan(E.queries()[key](spark, sf_dir)), STORED[key]):
        assert STORED[key] + ":struct<" in schema


def test_the_stored_document_is_shredded(spark, sf_dir):
    file = W.business_documents(spark, sf_dir).inputFiles()[0].removeprefix("file:")
    paths = [pq.ParquetFile(file).schema.column(i).path for i in range(len(pq.ParquetFile(file).schema))]
    assert any(p.startswith("business_doc.typed_value.overview.typed_value.city") for p in paths), paths


def test_stored_and_parsed_documents_give_the_same_rows(spark, sf_dir):
    with_doc, text = W.business_documents(spark, sf_dir), W.businesses(spark, sf_dir)
    assert J.DOCUMENT not in text.columns
    r = W.reviews(spark, sf_dir)
    for ask in (Qa.generated_columns, Q.biz_with_instagram, Q.influencer_potential, Q.social_gap, lambda b: V.market_leaders(b, r), lambda b: V.business_summary(b, r)):
        got, want = (sorted(map(repr, ask(b).collect())) for b in (with_doc, text))
        assert got == want and want


ODD = ['{"s":{"ig":null,"n":3}}', '{"s":{"ig":"u","n":"3"}}', '{"s":{}}', '{"s":null}', '{"s":[1,2]}', '{"s":"ig"}', "{}", "[]", "3", "null",
       "no json", "", '{"s":{"ig":""}}', '{"s":{"ig":{"a":1},"n":1.50}}', '{"s":{"ig":true}}', '{"s":{"i.g":1}}', None]


def test_odd_documents(spark, tmp_path):
    """Nulls, scalars, arrays, nested and broken documents, from a stored VARIANT whose rows differ in kind."""
    spark.createDataFrame(list(enumerate(ODD)), "id int, d string").select("id", F.try_parse_json("d").alias("v")).coalesce(1).write.parquet(str(tmp_path / "odd"))
    v = F.col("v")
    rows = spark.read.parquet(str(tmp_path / "odd")).select(
        "id", J.has_key_at(v, "ig", "s").alias("key"), J.has_value_at(v, "s").alias("value"), J.text_at(v, "s", "ig").alias("text"),
        J.has_any_key_at(v, ["ig", "i.g"], "s").alias("any"), J.has_all_keys_at(v, ["ig", "n"], "s").alias("all"),
        J.has_any_key_at(v, [], "s").alias("none")).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        try:
            s = json.loads(ODD[r["id"]])["s"]
        except (TypeError, ValueError, KeyError):
            s = None
        inner = s if isinstance(s, dict) else {}
        text = inner.get("ig")
        text = {dict: lambda t: json.dumps(t, separators=(",", ":")), bool: lambda t: str(t).lower()}.get(type(text), lambda t: t)(text)
        assert (r["key"], r["value"], r["text"], r["any"], r["all"], r["none"]) == (
            "ig" in inner, s is not None, text, bool({"ig", "i.g"} & set(inner)), {"ig", "n"} <= set(inner), False), ODD[r["id"]]
