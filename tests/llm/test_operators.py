"""Each operator against brute force on small tables with awkward rows."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from cellscape.llm import (
    bpe, decontam, exact_dedup, langid, license_scan, ngram_join, quality, shard, suffix_dedup, url_filter,
)

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Columns whose names clash with those that the operators make.
DOCS = ("doc_id long, text string, lang string, source string, keep_id string, n int, label string, spans int, ids int, "
        "score string, digest int, _hash int")


def docs_of(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", None, "x", 1, "l", 2, 3, "s", 4, 5) for i, t in zip(ids, texts)], DOCS)


def blank_words(text):
    return [w for w in re.split("[ \t-\r]+", (text or "").translate(LOWER)) if w]


def plain_words(text):
    return re.findall("[0-9a-z\x80-\U0010ffff]+", (text or "").translate(LOWER))


def prose(rnd, n, vocabulary=400):
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(n))


def awkward_texts(seed=3):
    rnd = random.Random(seed)
    base = [prose(rnd, rnd.choice([5, 40, 120])) for _ in range(12)]
    near = [" ".join(w if rnd.random() > 0.02 else "zz" for w in b.split()) for b in base for _ in range(3)]
    return base + near + base[:4] * 3 + [None, "", " \n\t ", "one", "One two", base[0].upper(), prose(rnd, 6000), "é" * 3000]


# --- 1 ---------------------------------------------------------------------------------------------

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "allow"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def test_url_rules(spark):
    urls = ["http://a.Example.org/es/x?q", "https://example.org/en/12", "http://notexample.org/es/", "http://x.com/de/1#f",
            "http://com/fr/", "http://x.com", "http://x.com/d", None, "", "nonsense", "ftp://org?x=/es/", "x://Y.ORG/", "://org/",
            "http://" + "a." * 3000 + "com/de/" + "p" * 5000, "http://x.com/de/1#f"]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    rules = spark.createDataFrame([*RULES, ("com", None, "block"), ("org", "/", "allow")], "host string, path string, verdict string")
    got = {r.page_id: r for r in url_filter.url_verdicts(pages, rules).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", u or "")
        host, path = (m[1].translate(LOWER), m[2]) if m else ("", "")
        fits = [r for r in RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
        best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
        want = (host, path, best and best[0] + best[1], best[2] if best else "allow")
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == want, u
    assert url_filter.url_verdicts(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in url_filter.url_verdicts(pages, rules.limit(0)).collect()} == {"allow"}


def test_url_rules_of_the_query(spark, tmp_path):
    from pyspark.sql import functions as F

    from cellscape.llm import queries as llm_queries

    pages = {"https://example.org/en/12": ("example.org/en/1", "block"), "http://a.example.org/en/1": ("example.org/en/1", "block"),
             "http://example.org/en/2": ("org/", "allow"), "http://example.org/es/": ("example.org/es/", "block"),
             "http://x.org/en/1": ("org/", "allow"), "http://x.com/fr/1": ("com/fr/", "allow"), "http://x.com/de/1": ("com/de/", "block")}
    spark.createDataFrame(list(pages), "string").withColumnRenamed("value", "url").withColumn("page_id", F.col("url")).write.parquet(
        str(tmp_path / "pages.parquet"))
    got = llm_queries.op1_url_filter(spark, str(tmp_path)).collect()
    assert {r.page_id: (r.rule, r.verdict) for r in got} == pages


# --- 2 ---------------------------------------------------------------------------------------------

def test_exact_groups(spark):
    texts = awkward_texts() + ["a b", "a  b", "a\n\tb", " a b", "A b"]
    ids = [900 - i for i in range(len(texts))]
    ids[1], ids[2] = None, ids[0]
    docs = docs_of(spark, texts, ids)
    groups = collections.defaultdict(list)
    for i, t in zip(ids, texts):
        groups[re.sub("[ \t-\r]+", " ", t or "")].append(i)
    got = collections.Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256)
                              for r in exact_dedup.exact_groups(docs).collect())
    want = collections.Counter()
    for norm, members in groups.items():
        named = [i for i in members if i is not None]
        keep = min(named) if named else None
        for i in members:
            want[i, keep, len(members), i == keep, hashlib.sha256(norm.encode()).hexdigest()] += 1
    assert got == want
    kept = exact_dedup.deduplicate(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)
    assert exact_dedup.exact_groups(docs.limit(0)).count() == 0


def test_exact_groups_tells_collisions_apart(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(exact_dedup.F, "md5", lambda c: F.lit("same"), raising=True)
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.exact_groups(docs_of(spark, ["a", "b", "a"])).collect()}
    assert got == {0: (0, 2), 1: (1, 1), 2: (0, 2)}


# --- 3 ---------------------------------------------------------------------------------------------

def test_bpe_round_trip_and_reference_library(spark):
    import public_tokenizers as P
    import tiktoken

    tokens = bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("x", pat_str=P.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    rnd = random.Random(1)
    texts = awkward_texts() + ["a" * 5000, "  lead", "x  \n y ", "it's 'LL we’ll", "<|endoftext|>", "日本語のテキスト 12３ ⅷ²"] + [
        "".join(rnd.choice("ab \n\té日1!'s") for _ in range(60)) for _ in range(150)]
    out = bpe.decode(bpe.encode(docs_of(spark, texts), tokens, P.PATTERN), tokens).collect()
    assert len(out) == len(texts)
    for r in out:
        assert list(r.ids) == library.encode_ordinary(texts[r.doc_id] or "")
        assert bytes(r.decoded) == (texts[r.doc_id] or "").encode()
    both = {r.doc_id: r for r in bpe.round_trip(docs_of(spark, texts), tokens, P.PATTERN).collect()}
    assert {r.doc_id: (r.ids, r.decoded) for r in out} == {i: (r.ids, r.decoded) for i, r in both.items()}
    assert bpe.encode(docs_of(spark, ["a"]).limit(0), tokens, P.PATTERN).count() == 0


def test_bpe_join_is_associative_with_any_split():
    import public_tokenizers as P

    codec = bpe.Codec(bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken")), P.PATTERN)
    rnd = random.Random(2)
    for _ in range(300):
        data = "".join(rnd.choice("abcdethin ") for _ in range(rnd.randrange(2, 60))).encode()
        cut = rnd.randrange(1, len(data))
        assert codec.join(codec._merge_long(data[:cut]), codec._merge_long(data[cut:])) == codec._merge_long(data) == codec.merge(data)


# --- 4 ---------------------------------------------------------------------------------------------

@pytest.mark.parametrize("k,similarity", [(3, 90), (5, 80)])
def test_linked_groups(spark, k, similarity):
    texts = awkward_texts(9)
    sets = []
    for t in texts:
        w = blank_words(t)
        sets.append({tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    low = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= similarity * len(a | b):
                    low[i] = low[j] = min(low[i], low[j])
    docs = docs_of(spark, texts)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.linked_groups(docs, k, similarity).collect()}
    assert got == {i: (len(s), low[i]) for i, s in enumerate(sets)}
    kept = ngram_join.one_of_each_group(docs, k, similarity)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(low)


@pytest.mark.parametrize("k, similarity, apart, own", [(3, 90, 5, 2), (5, 80, 10, 4)])
def test_linked_groups_of_two_families(spark, k, similarity, apart, own):
    """Only a and b link two families, and each family is the larger one in half of the blocks that a and b share."""
    texts = []
    for group in range(4):
        word = lambda kind, n: [f"{kind}{group}q{i}" for i in range(n)]  # noqa: E731, B023
        core, x, y = word("c", 100 - apart + k - 1), word("x", apart), word("y", apart)
        texts += [x + core, core + y]
        for i in range(3):
            texts.append(word(f"u{i}", 1) + x[own:] + core[:30] + word("za", 1) + core[31:])
            texts.append(core[:60] + word("zb", 1) + core[61:] + y[:-own] + word(f"v{i}", 1))
    rows = {r.doc_id: r for r in ngram_join.linked_groups(
        docs_of(spark, [" ".join(t) for t in texts]), k, similarity).collect()}
    assert rows[0].n_shingles == rows[1].n_shingles == 100
    assert {i: r.component_id for i, r in rows.items()} == {i: i // 8 * 8 for i in range(len(texts))}


def test_linked_groups_without_ids_and_rows(spark):
    docs = docs_of(spark, ["a b c d e f", "a b c d e f", "a b c d e f"], [None, 7, 7])
    got = sorted(((r.doc_id, r.component_id) for r in ngram_join.linked_groups(docs).collect()), key=str)
    assert got == [(7, 7), (7, 7), (None, None)]
    assert ngram_join.linked_groups(docs.limit(0)).count() == 0


# --- 5 ---------------------------------------------------------------------------------------------

def test_kd_shards(spark):
    rnd = random.Random(4)
    texts = [prose(rnd, rnd.randrange(1, 60)) for _ in range(1500)] + [prose(rnd, 30)] * 700 + [None, ""]
    rows = list(shard.kd_shards(docs_of(spark, texts), 16, dims=["lang", "source"]).collect())
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    load, slots = collections.Counter(), collections.defaultdict(list)
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + 1, zlib.crc32(data))
        load[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert set(load) == set(range(16)) and max(load.values()) - min(load.values()) < 0.03 * sum(load.values()) / 16 + 400
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    few = shard.kd_shards(docs_of(spark, ["a", None]), 16).collect()
    assert len(few) == 2 and all(0 <= r.shard < 16 and r.slot >= 0 for r in few)
    assert shard.kd_shards(docs_of(spark, ["a"]).limit(0), 16).count() == 0
    assert len({r.shard for r in shard.kd_shards(docs_of(spark, texts), target_bytes=50_000).collect()}) > 1


# --- 6 ---------------------------------------------------------------------------------------------

def test_license_scan(spark):
    rnd = random.Random(5)
    notice = "Permission is hereby granted free of charge to any person obtaining a copy of this software"
    templates = spark.createDataFrame([("n", notice), ("r", "All rights reserved."), (None, "x y"), ("e", None)],
                                      "template_id string, text string")
    changed = notice.replace("free of charge", "free of fee")
    texts = [prose(rnd, 50) + " " + notice + " " + prose(rnd, 50), "ALL Rights, reserved", "all rights are reserved", changed,
             notice[:40], None, "", prose(rnd, 5000) + " all rights reserved", notice + " " + notice]
    docs = docs_of(spark, texts)
    got = {r.doc_id: list(r.licenses) for r in license_scan.license_scan(docs, templates).collect()}
    assert got == {0: ["n"], 1: ["r"], 2: [], 3: ["n"], 4: [], 5: [], 6: [], 7: ["r"], 8: ["n"]}
    assert license_scan.license_scan(docs, templates.limit(0)).count() == len(texts)
    assert license_scan.license_scan(docs.limit(0), templates).count() == 0


def brute_licenses(text, sets, stride):
    """Templates with a window that holds 0.8 of their shingles, none of a better one's shingles only."""
    w, out = plain_words(text), set()
    at = [tuple(w[j:j + 2]) for j in range(len(w) - 1)]
    for size in set(stride.values()):
        for start in range(0, len(at), size):
            have = set(at[start:start + 2 * size])
            held = {i: sets[i] & have for i in sets if stride[i] == size and len(sets[i] & have) >= 0.8 * len(sets[i])}
            share = {i: len(g) / len(sets[i]) for i, g in held.items()}
            out |= {i for i in held if not any(share[j] > share[i] and held[i] <= held[j] for j in held)}
    return out


def test_whole_licenses_and_near_variants(spark):
    from cellscape.llm import queries

    rnd = random.Random(8)
    shipped = dict([*queries.LICENSES, *license_scan.shipped_templates()])
    sets = {i: {tuple(w[j:j + 2]) for j in range(len(w) - 1)} for i, w in ((i, plain_words(t)) for i, t in shipped.items())}
    stride = {i: 2 ** (len(plain_words(t)) - 1).bit_length() for i, t in shipped.items()}
    near = [(a, b) for a in sets for b in sets if a != b and 0.8 <= len(sets[a] & sets[b]) / len(sets[a]) < 1]
    assert ("GPL-3.0", "AGPL-3.0#statement") in near and ("BSD-2-Clause#text", "BSD-3-Clause#text") in near
    short = [i for i in sets if stride[i] < 1024]
    assert all(stride[a] == stride[b] for a, b in near if b in short)  # so that they meet in one window
    texts = [prose(rnd, 40) + "\n" + t + "\n" + prose(rnd, 40) for t in shipped.values()]
    texts.append("Released under the MIT License. Licensed under CC BY-NC-SA 4.0.")
    templates = spark.createDataFrame(list(shipped.items()), "template_id string, text string")
    found = license_scan.license_scan(docs_of(spark, texts), templates, explained=True)
    got = {r.doc_id: set(r.licenses) for r in found.collect()}
    assert got == {i: brute_licenses(t, sets, stride) for i, t in enumerate(texts)}
    assert got.pop(len(shipped)) == {"MIT", "CC-BY-NC-SA-4.0#statement"}
    named = {i: got[n] for n, i in enumerate(shipped)}
    assert all(i in names for i, names in named.items())
    assert all(named[i] == {j for j in sets if sets[j] <= sets[i]} for i in short)


# --- 7 ---------------------------------------------------------------------------------------------

def brute_repeats(texts, length):
    count = collections.Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        hit = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if count[t[i:i + length]] > 1:
                hit[i:i + length] = True
        out.append(hit)
    return out


def test_remove_repeats(spark, monkeypatch):
    rnd = random.Random(6)
    passage = prose(rnd, 40)
    texts = [prose(rnd, 30) + passage + prose(rnd, 30), passage[7:] + " end", "ab" * 200, "x" * 300, passage, passage, None, "",
             prose(rnd, 3000) + passage + "é" * 50 + passage, *(passage[:80] + str(i) + passage[81:] for i in range(6))]
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 4096)  # several segments for the long text
    monkeypatch.setattr(suffix_dedup._Segment, "_powers", None)
    docs = docs_of(spark, texts)
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(docs, 60).collect()}
    for i, hit in enumerate(brute_repeats([(t or "").encode() for t in texts], 60)):
        data = np.frombuffer((texts[i] or "").encode(), np.uint8)
        starts = np.flatnonzero(np.diff(np.r_[0, hit.astype(int), 0]) == 1)
        stops = np.flatnonzero(np.diff(np.r_[0, hit.astype(int), 0]) == -1)
        assert [(s.start, s.stop) for s in got[i].spans] == list(zip(starts, stops, strict=True))
        assert bytes(got[i].kept) == data[~hit].tobytes() and got[i].n_bytes == len(data)
    assert suffix_dedup.remove_repeats(docs.limit(0), 60).count() == 0


# --- 8, 9 ------------------------------------------------------------------------------------------

def test_language_mixtures(spark):
    rnd = random.Random(7)
    parts = {"aa": "the and ing ed er".split(), "bb": "ción que los del ñ".split()}
    say = lambda lang, n: " ".join("".join(rnd.choice(parts[lang]) for _ in range(3)) for _ in range(n))
    train = spark.createDataFrame([(say(k, 80), k) for k in parts for _ in range(20)] + [(None, "aa"), ("x", None)], "text string, lang string")
    model = langid.train(train)
    assert model.languages == ["aa", "bb"]
    texts = [say("aa", 50), say("bb", 50), say("aa", 60) + " " + say("bb", 30), None, "", "12 !!", say("bb", 5000), say("aa", 50)]
    got = {r.doc_id: r for r in langid.detect(docs_of(spark, texts), model).collect()}
    assert [got[i].lang_pred for i in range(8)] == ["aa", "bb", "aa", "und", "und", "und", "bb", "aa"]
    assert len(got[2].languages) == 2 and len(got[0].languages) == 1 and abs(got[2].score - 2 / 3) < 0.15
    assert all(0 <= r.score <= 1 for r in got.values())
    empty = langid.train(train.limit(0))
    assert {r.lang_pred for r in langid.detect(docs_of(spark, texts), empty).collect()} == {"und"}


def test_language_accuracy_on_held_out_rows(spark):
    import __spark_entry__ as E

    rows = E.queries()["op8_language_id"](spark, "/root/testdata/sf0.001").join(
        spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.9


def test_quality_classifier(spark):
    rnd = random.Random(8)
    good = [prose(rnd, 40) for _ in range(60)]
    bad = [prose(rnd, 40).upper().replace(" ", "!! ") for _ in range(60)]
    docs = docs_of(spark, good + bad + [None, "", prose(rnd, 5000)])
    labels = spark.createDataFrame([(i, int(i < 60)) for i in range(0, 120, 2)] + [(None, 1), (1, None), (0, 1)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    got = {r.doc_id: float(r.score) for r in quality.score(docs, model).collect()}
    assert len(got) == 123 and all(0 <= s <= 1 for s in got.values()) and got[120] == got[121]
    assert min(got[i] for i in range(1, 60, 2)) > max(got[i] for i in range(61, 120, 2))
    blank = quality.train(docs, labels.limit(0))
    assert {r.score for r in quality.score(docs, blank).collect()} == {0.5}
    assert quality.score(docs.limit(0), model).count() == 0


# --- 10 --------------------------------------------------------------------------------------------

def test_contamination(spark):
    rnd = random.Random(10)
    items = [prose(rnd, 30), prose(rnd, 14), "w1 w2 w3 w4", "Solo", "two words", None, "", "!!!"]
    texts = [prose(rnd, 100) + " " + items[0][5:] + " " + prose(rnd, 40), items[1], items[1][3:], "a W1, w2. w3\nw4 b", "solo solo",
             "x two  words y two", None, "", prose(rnd, 4000) + " " + items[1], prose(rnd, 50), items[1]]
    bench = spark.createDataFrame([(i, t, 1) for i, t in enumerate(items)] + [(0, items[0], 2)], "item_id long, text string, doc_id int")
    docs = docs_of(spark, texts)
    got = {r.doc_id: r for r in decontam.contamination(docs, bench).collect()}
    for d, t in enumerate(texts):
        w, hit, found = plain_words(t), set(), set()
        for i, item in enumerate(items):
            x = plain_words(item)
            for window in ([x[j:j + 13] for j in range(max(1, len(x) - 12))] if x else []):
                for s in range(len(w) - len(window) + 1):
                    if w[s:s + len(window)] == window:
                        hit |= set(range(s, s + len(window)))
                        found.add(str(i))
        want = (len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w))
        assert (got[d].n_words, got[d].n_hit, list(got[d].items), got[d].contaminated) == want, d
    clean = decontam.decontaminate(docs, bench)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {d for d in got if not got[d].contaminated}
    assert not any(r.contaminated for r in decontam.contamination(docs, bench.limit(0)).collect())
    assert decontam.contamination(docs.limit(0), bench).count() == 0
