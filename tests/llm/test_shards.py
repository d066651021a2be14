"""How stretches are put in shards."""

from millrace.llm import substring_dedup


def test_shards_hold_whole_marks_and_stay_small():
    rows = [(mark, n, bytes(700)) for mark in range(1500) for n in range(3)]
    made = list(substring_dedup.shards(rows))
    assert [row for shard in made for row in shard] == rows
    marks = [{row[0] for row in shard} for shard in made]
    assert sum(len(m) for m in marks) == 1500
    # At most the last mark goes beyond.
    assert max(sum(len(row[2]) for row in shard) for shard in made) <= 500_000 + 3 * 700


def test_one_large_mark_is_one_shard():
    rows = [(1, n, bytes(712)) for n in range(substring_dedup.SHARD_STRETCHES)] + [(2, 0, bytes(200))]
    assert [len(shard) for shard in substring_dedup.shards(rows)] == [substring_dedup.SHARD_STRETCHES, 1]
    assert list(substring_dedup.shards([])) == []
