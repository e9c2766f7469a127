"""Changes whose values are of any JSON type."""

from loglattice.plans import documents

TEXTS = [
    '{"changes":[{"field":"a","from":1,"to":"x"},{"field":"a","from":1.5,"to":null},{"field":"b","from":true,"to":[1,{"k":2}]}]}',
    '{"changes":[]}', '{"other":1}', '{"changes":"no list"}', '{"changes":[5,{"field":7}]}', "{ broken", "no object", None, '{"changes":[{"field":"a","from":{"d":1}}]}',
]


def typed(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, message string")
    return documents.changes_typed(df).collect()


def test_every_type_has_its_column(spark):
    rows = [r.asDict() for r in typed(spark)]
    first = [r for r in rows if r["id"] == 0]
    assert {(r["field"], r["from_type"], r["from_number"], r["from_flag"], r["to_type"], r["to_text"], r["to_json"]) for r in first} == {
        ("a", "number", 1.0, None, "text", "x", None), ("a", "number", 1.5, None, "null", None, None), ("b", "flag", None, True, "array", None, '[1,{"k":2}]'),
    }
    (nested,) = [r for r in rows if r["id"] == 8]
    assert (nested["from_type"], nested["from_json"], nested["to_type"]) == ("object", '{"d":1}', None)


def test_odd_documents_keep_a_row_and_other_texts_are_left_out(spark):
    rows = typed(spark)
    assert sorted({r["id"] for r in rows}) == [0, 1, 2, 3, 4, 5, 8]
    assert all(r["field"] is None and r["from_type"] is None for r in rows if r["id"] in (1, 2, 3, 5))
    assert {r["field"] for r in rows if r["id"] == 4} == {None, "7"}


def test_schemas_show_drift(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, message string")
    got = {r["field"]: (r["n"], r["from_schema"], r["to_schema"]) for r in documents.change_schemas(df).collect()}
    assert got["a"][0] == 3 and got["a"][1] == "VARIANT" and got["b"][1:] == ("BOOLEAN", "ARRAY<VARIANT>")
