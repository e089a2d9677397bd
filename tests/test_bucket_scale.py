"""A table has a bounded number of folders."""

from orderloom.streaming import upsert as up


def test_buckets_are_bounded():
    assert up.buckets_for(10 ** 9, 500) == up.MAX_BUCKETS
    assert [up.buckets_for(n, 500) for n in (0, 500, 501, 2001)] == [1, 1, 4, 16]
