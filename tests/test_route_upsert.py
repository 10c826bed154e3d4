from eddy.operators import route, upsert

SCHEMA = "id long, name string, title string, age int, off long"


def test_route_negative_and_null_ids(spark):
    df = spark.createDataFrame([(-3,), (4,), (None,)], "id long")
    assert [r["id"] for r in route.route_even(df).collect()] == [4]
    odd = route.route_odd_keyed(df).collect()
    assert [(r["key"], r["id"]) for r in odd] == [(-1, -3)]
    assert route.dead_letters(df).count() == 1


def test_route_nested_record(spark):
    df = spark.createDataFrame([(5, "x")], "id long, name string")
    r = route.route_odd_keyed(df, nest="record").first()
    assert r["key"] == 2 and r["record"]["name"] == "x"


def test_upsert_last_write(spark):
    df = spark.createDataFrame([(1, "Ann", "Dev", 30, 0), (2, "Bob", "Ops", 40, 1),
                                (1, "Ann", "Lead", 31, 2)], SCHEMA)
    got = sorted(tuple(r) for r in
                 upsert.upsert_last_write(df, ["id", "name"], "off", ["title", "age"]).collect())
    assert got == [(1, "Ann", "Lead", 31), (2, "Bob", "Ops", 40)]


def test_upsert_ignore_nulls(spark):
    df = spark.createDataFrame([(1, "Ann", "Dev", 30, 0), (1, "Ann", None, 31, 1),
                                (1, "Ann", "Lead", None, 2)], SCHEMA)
    got = upsert.upsert_ignore_nulls(df, ["id", "name"], "off", ["title", "age"]).collect()
    assert [tuple(r) for r in got] == [(1, "Ann", "Lead", 31)]


def test_positional_binds_and_rename(spark):
    df = spark.createDataFrame([(1, "Ann", "Dev", 30, 0)], SCHEMA)
    # tuple sink: (name, id, age, title) bound in that order
    t = upsert.bind_positional(df, ["name", "id", "age", "title"], ["name", "id", "age", "title"])
    assert t.columns == ["name", "id", "age", "title"]
    emp = upsert.rename(df, {"id": "eId", "name": "eName", "title": "eTitle", "age": "eAge"})
    back = upsert.rename(emp, {"eId": "id", "eName": "name", "eTitle": "title", "eAge": "age"})
    assert tuple(back.first()) == (1, "Ann", "Dev", 30)
    try:
        upsert.bind_positional(df, ["id"], ["id", "name"])
        raise AssertionError("expected a length error")
    except ValueError:
        pass


def test_last_write_of_texts_by_locator(spark):
    """Text values: null keys and values, a row written twice, and a late smaller order."""
    rows = [(1, "a", 5, "x"), (1, "a", 9, None), (1, "a", 9, None), (1, None, 3, "n"), (1, None, 2, "m"), (None, "a", 1, "z"), (2, "b", 4, "y")]
    df = spark.createDataFrame(rows, "id long, name string, at long, title string")
    got = upsert.upsert_last_write(df, ["id", "name"], "at", ["title", "at"])
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(1, "a", None, 9), (1, None, "n", 3), (None, "a", "z", 1), (2, "b", "y", 4)], key=str)
