"""Page walks: duplicate links, several runs, loops, caps and long chains."""
import pytest

from ratewatch.operators import chain
from ratewatch.operators.chain import LOOP_TEXT, follow_links


def _walk(spark, starts, links, **kw):
    s = spark.createDataFrame(starts, "provider_id string, url string")
    df = spark.createDataFrame(links, "provider_id string, url string, next_url string, usable boolean")
    return sorted((r.provider_id, r.page_num, r.url, r.error) for r in follow_links(s, df, **kw).collect())


def test_links_stored_twice_give_each_page_once(spark):
    links = [("p", f"u{i}", f"u{i + 1}" if i < 9 else None, True) for i in range(10)]
    got = _walk(spark, [("p", "u0"), ("p", "u0")], links + links)
    assert got == [("p", i + 1, f"u{i}", None) for i in range(10)]


def test_long_chain_is_walked_to_its_end(spark):
    links = [("p", f"u{i}", f"u{i + 1}", True) for i in range(700)]
    got = _walk(spark, [("p", "u0")], links)
    assert len(got) == 701 and got[-1][1] <= 701
    assert [x[1] for x in sorted(got, key=lambda x: x[1])] == list(range(1, 702))


def test_loop_cap_unusable_and_missing_start(spark):
    links = [("loop", "a", "b", True), ("loop", "b", "c", True), ("loop", "c", "b", True), ("self", "x", "x", True),
             ("bad", "m", "n", True), ("bad", "n", "o", False), ("end", "e", "", True)]
    got = _walk(spark, [("loop", "a"), ("self", "x"), ("bad", "m"), ("end", "e"), ("none", "z")], links)
    assert got == sorted([("loop", 1, "a", None), ("loop", 2, "b", None), ("loop", 3, "c", None), ("loop", 4, "b", LOOP_TEXT),
                          ("self", 1, "x", None), ("self", 2, "x", LOOP_TEXT), ("bad", 1, "m", None), ("bad", 2, "n", None),
                          ("end", 1, "e", None), ("none", 1, "z", None)], key=lambda r: (r[0], r[1]))
    capped = _walk(spark, [("loop", "a")], links, cap=2)
    assert capped == [("loop", 1, "a", None), ("loop", 2, "b", None), ("loop", 3, "c", "Pagination limit exceeded (2)")]


@pytest.mark.parametrize("most", [10_000, 25, 0])
def test_null_keys_and_walks_below_and_above_a_group(spark, monkeypatch, most):
    monkeypatch.setattr(chain, "MOST_LINKS", most)
    n = 40
    links = [(f"p{i}", f"u{j}", f"u{j + 1}", True) for i in range(1, 4) for j in range(n // i)] + [(None, "u0", "u1", True)]
    links += [("loop", "a", "b", True), ("loop", "b", "c", True), ("loop", "c", "b", True)]
    starts = [("p1", "u0"), ("p2", "u0"), ("p3", "u0"), ("p3", "u9"), (None, "u0"), ("p4", None), ("loop", "a")]
    s = spark.createDataFrame(starts, "provider_id string, url string")
    df = spark.createDataFrame(links, "provider_id string, url string, next_url string, usable boolean")
    got = {tuple(r)[:3] + (r.error,) for r in follow_links(s, df).collect()}
    want = {(f"p{i}", j + 1, f"u{j}", None) for i in range(1, 4) for j in range(n // i + 1)} | {(None, 1, "u0", None)}
    assert got == want | {("loop", 1, "a", None), ("loop", 2, "b", None), ("loop", 3, "c", None), ("loop", 4, "b", LOOP_TEXT)}
    capped = {(r.provider_id, r.page_num, r.error) for r in follow_links(s, df, cap=20).collect() if r.error}
    assert capped == {("p1", 21, "Pagination limit exceeded (20)"), ("p2", 21, "Pagination limit exceeded (20)"), ("loop", 4, LOOP_TEXT)}


def test_short_walks_take_few_steps(spark, monkeypatch):
    """Walks that fit a group are written thrice (walks, links, long walks), not once a round."""
    from pyspark.sql.classic.dataframe import DataFrame
    kept, plain = [], DataFrame.checkpoint
    monkeypatch.setattr(DataFrame, "checkpoint", lambda self, *a, **b: kept.append(self.columns) or plain(self, *a, **b))
    links = [("p", f"u{i}", f"u{i + 1}", True) for i in range(100)]
    assert len(_walk(spark, [("p", "u0")], links)) == 101
    assert len(kept) == 3
