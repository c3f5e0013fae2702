"""op5: groups of equal texts, strings with a long common prefix, awkward rows."""

import collections
import random

from cellscape.llm import shard

DOCS = "doc_id long, text string, lang string, source string, rid int, same int, rank int"


def test_groups_of_equal_texts_stay_together(spark):
    rnd = random.Random(8)
    texts = [" ".join(f"w{rnd.randrange(500)}" for _ in range(rnd.randrange(5, 80))) for _ in range(900)]
    texts += [rnd.choice(texts) for _ in range(300)]
    rows = [(i, t, rnd.choice(["en", "fr", None]), f"https://www.example.org/{rnd.randrange(40)}", 1, 2, 3) for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in shard.kd_shards(spark.createDataFrame(rows, DOCS), 16, dims=["lang", "source"]).collect()}
    where, load = collections.defaultdict(set), collections.Counter()
    for i, t in enumerate(texts):
        where[t].add(got[i].shard)
        load[got[i].shard] += got[i].size
    split = sum(len(s) > 1 for s in where.values())
    assert split <= 16  # at most where a cut had to go through a group
    assert set(load) == set(range(16)) and max(load.values()) < 1.1 * sum(load.values()) / 16


def test_long_common_prefixes_are_cut_apart(spark):
    rows = [(7, f"text {i}", "en", f"https://example.org/{i // 50:03d}", 1, 2, 3) for i in range(400)]
    got = shard.kd_shards(spark.createDataFrame(rows, DOCS), 8, dims=["source"]).collect()
    shards = collections.defaultdict(set)
    for r, crc in ((r, r.text_crc32) for r in got):
        shards[r.shard].add(crc)
    assert len(shards) == 8 and all(40 <= len(s) <= 60 for s in shards.values())


def test_null_ids_and_very_long_texts(spark):
    rows = [(None, "same", None, None, 1, 2, 3)] * 4 + [(5, "x" * 200_000, "en", "s", 1, 2, 3)] + [(i, f"t{i}", "en", "s", 1, 2, 3) for i in range(50)]
    got = shard.kd_shards(spark.createDataFrame(rows, DOCS), 4, dims=["lang", "source"]).collect()
    assert len(got) == len(rows) and len({r.shard for r in got if r.doc_id is None}) == 1
    assert [r.size for r in got if r.size > 1000] == [200_001]
