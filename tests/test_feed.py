"""Changes from version to version."""

import pytest
from conftest import rows

from usageledger.operators.reconcile import DuplicateKeys
from usageledger.plans.publish import publish_swap
from usageledger.session import remove
from usageledger.streaming.feed import feed_stream, publish_with_feed, row_changes
from usageledger.streaming.loads import append_stream, history

KEYED = "a string, b int, v string"


def test_kinds_of_changes(spark):
    old = spark.createDataFrame([("x", 1, "same"), ("x", 2, "old"), ("y", None, None), (None, 3, "n"), ("z", 1, "gone")], KEYED)
    new = spark.createDataFrame([("x", 1, "same"), ("x", 2, "new"), ("y", None, "set"), (None, 3, "n"), ("w", 1, None)], KEYED)
    got = rows(row_changes(old, new, ["a", "b"]))
    want = [
        ("delete", "z", 1, "gone"), ("insert", "w", 1, None), ("update_after", "x", 2, "new"), ("update_after", "y", None, "set"),
        ("update_before", "x", 2, "old"), ("update_before", "y", None, None),
    ]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert row_changes(old, old, ["a", "b"]).count() == 0
    assert {r[0] for r in rows(row_changes(None, old, ["a", "b"]))} == {"insert"}
    with pytest.raises(DuplicateKeys):
        row_changes(old, new.union(new.limit(1)), ["a", "b"])


def test_a_stream_consumes_each_version_once_and_a_broken_publish_is_caught_up(spark, tmp_path):
    where, feed = str(tmp_path / "t"), str(tmp_path / "feed")
    frame = lambda k: spark.createDataFrame([(f"k{i}", i, f"v{k if i == k else 0}") for i in range(3 + k)], KEYED)

    def consumed():
        append_stream(feed_stream(spark, feed, frame(0).schema), str(tmp_path / "seen"), str(tmp_path / "checkpoint"))
        seen = history(spark, str(tmp_path / "seen"))
        return {(r.version, r.change_type): r["count"] for r in seen.groupBy("version", "change_type").count().collect()}

    publish_with_feed(frame(0), "fed", where, feed, ["a"])
    assert consumed() == {(1, "insert"): 3}
    publish_with_feed(frame(1), "fed", where, feed, ["a"])
    first = {(1, "insert"): 3, (2, "insert"): 1, (2, "update_before"): 1, (2, "update_after"): 1}
    assert consumed() == first == consumed()  # nothing new, nothing more
    publish_swap(frame(2), "fed", where)  # broken off before its changes were written
    publish_with_feed(frame(2), "fed", where, feed, ["a"])
    later = consumed()
    assert later.items() > first.items() and {k for k in later if k[0] > 2} == {(3, "insert"), (3, "update_before"), (3, "update_after")}
    remove(spark, f"{feed}/version=4/_SUCCESS")  # written, but not to its end
    publish_with_feed(frame(2).limit(4), "fed", where, feed, ["a"])
    assert consumed()[5, "delete"] == 1
