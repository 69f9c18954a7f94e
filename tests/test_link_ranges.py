"""The sorted list that is merged range by range, against a full sort."""

import random

from tidemark.sources import merge_links, read_manifest, read_merged_links


def listed(spark, path):
    return [r.link for r in read_merged_links(spark, path).orderBy("file_ord").collect()]


def test_merges_equal_a_full_sort(spark, tmp_path):
    rng = random.Random(3)
    path, every = str(tmp_path / "list"), set()
    assert listed(spark, path) == []
    for n in (400, 60, 1, 300):
        some = [rng.choice("abcé日z/") + f"{rng.randint(0, 2000)}" for _ in range(n)] + [None]
        df = spark.createDataFrame([(x,) for x in some], "link string")
        merge_links(df, path, range_links=50)
        every |= {x for x in some if x}
        rows = read_merged_links(spark, path).orderBy("file_ord").collect()
        assert [r.link for r in rows] == sorted(every, key=str.encode) and [r.file_ord for r in rows] == list(range(len(every)))
    assert read_manifest(spark, path).agg({"links": "sum"}).first()[0] == len(every)


def test_only_touched_ranges_are_written(spark, tmp_path):
    path = str(tmp_path / "list")
    links = [f"https://h/{i:05d}.nc" for i in range(2000)]
    as_df = lambda rows: spark.createDataFrame([(x,) for x in rows], "link string")
    merge_links(as_df(links), path, range_links=100)
    before = {(r.folder, r.range, r.part): (r.low, r.links) for r in read_manifest(spark, path).collect()}
    assert len(before) >= 20
    # One in a hundred, all in one place, and some that are there already.
    new = [f"https://h/{700 + i // 10:05d}.nc.{i}" for i in range(20)]
    written = merge_links(as_df(new + links[::50]), path, range_links=100)
    after = {(r.folder, r.range, r.part): (r.low, r.links) for r in read_manifest(spark, path).collect()}
    assert written <= 3 and len(set(before) - set(after)) <= 2 and set(before) & set(after) == set(before) - (set(before) - set(after))
    assert listed(spark, path) == sorted(links + new)
    assert merge_links(as_df(links[:30]), path, range_links=100) == 0
    # Before and after all others.
    assert merge_links(as_df(["", "a", "zz"]), path, range_links=100) <= 3
    assert listed(spark, path) == sorted([*links, *new, "", "a", "zz"])
