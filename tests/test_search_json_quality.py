import pytest
from pyspark.sql import functions as F

from marketlens.functions import jsonops as J
from marketlens.operators import quality as Q
from marketlens.operators import search as S


# Published stems of the English stemmer.
STEMS = """consign consign|consigned consign|consignment consign|consistency consist|consistently consist|consolation consol|consolatory consolatori
|conspicuously conspicu|conspiracy conspiraci|conspirators conspir|constable constabl|constancy constanc|knackeries knackeri|knaves knave|knavish knavish
|kneel kneel|knightly knight|companies compani|company compani|pricing price|prices price|schedule schedul|scheduled schedul|charge charg|charged charg
|service servic|servicing servic|quote quot|quoting quot|party parti|parties parti|generate generat|generous generous|community communiti|happy happi|cry cri
|by by|say say|hopping hop|hoping hope|ties tie|cries cri|gas gas|gaps gap|feed feed|agreed agre|fluently fluentli|rational ration|relational relat
|hopeful hope|goodness good|formative format|electrical electr|adjustment adjust|adoption adopt|controll control|roll roll|parking park|missed miss
|appointment appoint|ponies poni|sing sing|news news|dying die|skies sky|proceed proceed|inning inning|boyish boyish|sensibility sensibl"""


def test_published_stems(spark, sf_dir):
    import duckdb

    from marketlens.oracle_stems import stemming
    pairs = [p.split() for p in STEMS.replace("\n", "").split("|")]
    assert [S.stem_word(w) for w, _ in pairs] == [s for _, s in pairs]
    words = "SELECT unnest([" + ", ".join(f"'{w}'" for w, _ in pairs) + "]) AS word"
    sql = dict(duckdb.sql(f"WITH {stemming(words)} SELECT word, stem FROM stemmed").fetchall())
    assert sql == {w: s for w, s in pairs if w not in S.STOP_WORDS}


@pytest.fixture(scope="module")
def texts(spark):
    df = spark.createDataFrame([(1, "Parking is tight"), (2, "no parking, bad service"), (3, "missed the appointment"), (4, "missed appointment"), (5, None),
                                (6, "two companies, upfront pricing"), (7, "the party of parties"), (None, "parking"), (8, ""), (9, "parking parking")], "id long, t string")
    return df, S.postings(df, "id", "t")


def test_postings_hold_positions(texts):
    _, table = texts
    assert {(r.stem, r.id): r.positions for r in table.where("id IN (3, 7, 9)").collect()} == {
        ("miss", 3): [1], ("appoint", 3): [3], ("parti", 7): [2, 4], ("park", 9): [1, 2]}


def test_searches(texts):
    df, table = texts
    w = lambda word, prefix=False: S.term(table, word, prefix)
    ids = lambda found: sorted(r["id"] for r in S.matching(df, found).collect())
    assert ids(w("parking")) == [1, 2, 9]
    assert ids(S.but_not(w("parking"), w("tight"))) == [2, 9]
    assert ids(S.every(S.either(w("tight"), w("bad")), w("parking"))) == [1, 2]
    assert ids(S.phrase(table, "missed", "appointment")) == [4]                  # a stop word keeps its position
    assert ids(S.phrase(table, "missed", "appointment", gaps=[2])) == ids(S.phrase(table, "missed", "the", "appointment")) == [3]
    assert ids(S.every(w("the"), w("parking"))) == ids(S.either(w("the"), w("parking"))) == ids(S.but_not(w("parking"), w("the"))) == [1, 2, 9]
    assert ids(w("the")) == ids(S.every()) == ids(S.phrase(table, "of", "the")) == []
    assert ids(w("company")) == [6] and ids(w("price")) == [6] and ids(S.phrase(table, "party", "party", gaps=[2])) == [7]
    assert ids(w("servic", True)) == [2] and ids(S.every(w("comp", True), w("pric", True))) == [6]
    assert ids(S.phrase(table, "parking", "parking")) == [9] and ids(w("nowhere")) == []


def test_sql_searches(spark, texts):
    df, table = texts
    S.register_sql(spark, table)
    ids = lambda sql: sorted(r.id for r in spark.sql(sql).collect())
    assert ids("SELECT * FROM texts_with('Parked')") == [1, 2, 9]
    assert ids("SELECT * FROM texts_with('parking') WHERE id NOT IN (SELECT id FROM texts_with('tight'))") == [2, 9]
    assert ids("SELECT * FROM texts_with_phrase('missed', 'appointments')") == [4]


@pytest.mark.parametrize("key", ["fts_term", "fts_boolean", "fts_phrase", "topic_complaints_per_business", "document_search", "document_term_frequencies"])
def test_no_python_runs_in_a_search(spark, sf_dir, key):
    import __spark_entry__ as E
    plan = E.queries()[key](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    if key in ("fts_term", "topic_complaints_per_business"):
        assert "EqualTo(stem,park)" in plan                                   # a term reads its own row groups


def test_json_operators(spark):
    df = spark.createDataFrame([('{"s":{"ig":null,"fb":"x"},"k":3}',), ('{"s":{},"k":"3"}',)], "d string")
    r = df.select(J.has_key(F.col("d"), "ig", "s").alias("h"),
                  J.has_any_key(F.col("d"), ["ig", "tw"], "s").alias("a"),
                  J.has_all_keys(F.col("d"), ["ig", "fb"], "s").alias("al"),
                  J.contains(F.col("d"), {"k": 3}).alias("c")).collect()
    assert [tuple(x) for x in r] == [(True, True, True, True), (False, False, False, False)]   # "3" is not 3


@pytest.mark.parametrize("doc,pattern,held", [
    ('{"k":3}', {"k": 3}, True), ('{"k":"3"}', {"k": 3}, False), ('{"k":3}', {"k": "3"}, False), ('{"k":3.0}', {"k": 3}, True), ('{"k":3.5}', {"k": 3.5}, True),
    ('{"k":null}', {"k": None}, True), ('{}', {"k": None}, False), ('{"k":true}', {"k": True}, True), ('{"k":1}', {"k": True}, False),
    ('{"tags":["a","b"]}', {"tags": ["a"]}, True), ('{"tags":["b","a"]}', {"tags": ["a", "b", "a"]}, True), ('{"tags":["a"]}', {"tags": ["c"]}, False),
    ('{"tags":[["a"]]}', {"tags": ["a"]}, False), ('{"tags":[["a","b"]]}', {"tags": [["a"]]}, True), ('{"a":{"b":{"c":1,"d":2}}}', {"a": {"b": {"d": 2}}}, True),
    ('[{"x":1,"y":2},3]', [{"x": 1}], True), ('["foo",1]', "foo", True), ('"foo"', "foo", True), ('{"a":[]}', {"a": []}, True), ('{"a":{}}', {"a": []}, False),
    ('{"a.b":1}', {"a.b": 1}, True), ("no json", {}, False), (None, {"k": 1}, False), ('{"k":123456789012345678901}', {"k": 123456789012345678901}, True)])
def test_json_containment(spark, doc, pattern, held):
    df = spark.createDataFrame([(doc,)], "d string")
    assert df.select(J.contains(F.col("d"), pattern)).first()[0] is held


def test_sql_key_functions(spark):
    J.register_sql(spark)
    one = spark.sql("""SELECT json_has_key('{"s":{"ig":null}}', '$.s', 'ig') AS a, json_contains_any_key('{"x":1}', '$', array('x', 'y')) AS b,
                              json_contains_all_keys('{"x":1}', '$', array('x', 'y')) AS c, json_has_key('[]', '$', 'x') AS d""").first()
    assert tuple(one) == (True, True, False, False)


def test_lenient_casts(spark):
    df = spark.createDataFrame([("5",), ("4.5",), ("five",), (" 7 ",), (None,)], "t string")
    got = [r[0] for r in df.select(Q.lenient_int(F.col("t"))).collect()]
    assert got == [5, None, None, 7, None]
    d = spark.createDataFrame([("2025-09-15T12:00:00.000Z",), ("not-a-date",)], "t string")
    assert [str(r[0]) for r in d.select(Q.lenient_date(F.col("t"))).collect()] == ["2025-09-15", "None"]


def test_split_and_strict_enforce(spark):
    df = spark.createDataFrame([(1, 5), (2, 99), (3, None)], "id long, stars int")
    good, bad = Q.split(df, Q.stars_ok(F.col("stars")))
    assert sorted(r["id"] for r in good.collect()) == [1, 3]
    assert [r["id"] for r in bad.collect()] == [2]
    with pytest.raises(ValueError):
        Q.enforce(df, Q.stars_ok(F.col("stars")), "stars_range", mode="strict")


def test_unique_violations_exempt_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "k string")
    assert [tuple(r) for r in Q.unique_violations(df, ["k"]).collect()] == [("a", 2)]
