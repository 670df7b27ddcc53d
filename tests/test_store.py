"""Published groups and merges under a manifest."""
import pytest
from pyspark.sql import functions as F

from ratewatch.sources import store

ROWS = "provider string, run string, page int, body string"


def _rows(spark, rows):
    return spark.createDataFrame(rows, ROWS)


def _got(df):
    return sorted(tuple(r) for r in df.collect())


def test_a_failed_provider_publishes_nothing(spark, tmp_path):
    root = str(tmp_path / "t")
    first = _rows(spark, [("a", "r1", 1, "x"), ("a", "r1", 2, "y"), ("b", "r1", 1, "z"), (None, "r1", 1, "n")])
    schema = first.schema
    assert store.read_published(spark, root, schema).count() == 0
    store.publish_groups(first, root, ["provider"], failed=_rows(spark, [("b", "r1", 1, None)]))
    assert _got(store.read_published(spark, root, schema).fillna("")) == [("", "r1", 1, "n"), ("a", "r1", 1, "x"), ("a", "r1", 2, "y")]
    # the second run replaces one provider, adds one; the provider that fails keeps what it had
    second = _rows(spark, [("b", "r2", 1, "zz"), ("a", "r2", 9, "half"), (None, "r2", 7, "m")])
    store.publish_groups(second, root, ["provider"], failed=_rows(spark, [("a", "r2", 0, None)]))
    assert _got(store.read_published(spark, root, schema).fillna("")) == [("", "r2", 7, "m"), ("a", "r1", 1, "x"), ("a", "r1", 2, "y"), ("b", "r2", 1, "zz")]
    assert store.read_published(spark, root, schema, version=1).count() == 3
    # everything failed: a version without changes
    store.publish_groups(second, root, ["provider"], failed=second)
    assert store.read_published(spark, root, schema).count() == 4


def test_a_write_that_dies_leaves_the_table_alone(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = _rows(spark, [("a", "r1", 1, "x")])
    store.publish_groups(rows, root, ["provider"])
    broken = _rows(spark, [("a", "r2", 1, "x"), ("b", "r2", 2, "1")]).withColumn("page", F.raise_error("fetch failed").cast("int"))
    with pytest.raises(Exception, match="fetch failed"):
        store.publish_groups(broken, root, ["provider"])
    assert store.latest_version(spark, root) == 1
    assert _got(store.read_published(spark, root, rows.schema)) == [("a", "r1", 1, "x")]


def test_one_of_two_writers_wins(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    rows = _rows(spark, [("a", "r1", 1, "x")])
    store.publish_groups(rows, root, ["provider"])
    monkeypatch.setattr(store, "latest_version", lambda *a: 0)      # a writer that began before the commit
    with pytest.raises(store.ConcurrentWrite):
        store.publish_groups(rows, root, ["provider"])


KEYED = "run string, page int, url string, body string"


def test_merge_rewrites_only_files_with_incoming_keys(spark, tmp_path):
    root, key = str(tmp_path / "t"), ["run", "page"]
    schema = spark.createDataFrame([], KEYED).schema

    def merge(rows, **kw):
        store.merge_into(spark.createDataFrame(rows, KEYED), root, key, **kw)
        return store.stored_files(spark, root)

    one = merge([("r1", i, f"u{i}", "a") for i in range(20)])
    two = merge([("r2", i, f"u{i}", "a") for i in range(20)])
    assert one < two                                               # other keys: nothing is rewritten
    three = merge([("r2", 5, "new", "b"), ("r2", 5, "newer", "c"), ("r2", 50, "u", "b")], order=[F.col("body")], keep_first=["url"])
    assert one < three and not (two - one) <= three
    rows = {(r.run, r.page): (r.url, r.body) for r in store.read_stored(spark, root, schema).collect()}
    assert len(rows) == 41 and rows["r2", 5] == ("u5", "c") and rows["r2", 50] == ("u", "b") and rows["r1", 5] == ("u5", "a")
    four = merge([("r1", 3, "no", "no"), ("r3", 1, "u", "b")], update=False)
    assert three < four
    rows = {(r.run, r.page): r.body for r in store.read_stored(spark, root, schema).collect()}
    assert rows["r1", 3] == "a" and rows["r3", 1] == "b" and len(rows) == 42
    assert store.read_stored(spark, root, schema, version=1).count() == 20
    with pytest.raises(ValueError, match="null in the key"):
        merge([(None, 1, "u", "b")])


def test_merge_of_nothing(spark, tmp_path):
    root = str(tmp_path / "t")
    none = spark.createDataFrame([], KEYED)
    store.merge_into(none, root, ["run", "page"])
    assert store.read_stored(spark, root, none.schema).count() == 0
    store.merge_into(spark.createDataFrame([("r", 1, "u", "b")], KEYED), root, ["run", "page"])
    store.merge_into(none, root, ["run", "page"])
    assert store.read_stored(spark, root, none.schema).count() == 1
