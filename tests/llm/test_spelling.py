"""op11 against all pairs of words."""

import collections
import random
import re
import zlib

from cellscape.llm import spelling
from cellscape.llm.queries import damaged_words, op11_spelling_variants

SMALL = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(docs, min_length=5, min_count=3):
    counts = collections.Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}


def grouped(counts):
    """Neighbours by the masks that two words at one edit share, checked character by character."""
    def one_edit(a, b):
        if len(a) > len(b):
            a, b = b, a
        i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
        return a != b and (a[i + 1:] == b[i + 1:] if len(a) == len(b) else len(a) + 1 == len(b) and a[i:] == b[i + 1:])

    masks = collections.defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            masks[w[:i] + w[i + 1:]].add(w)
        masks[w].add(w)
    near = collections.defaultdict(set)
    for group in masks.values():
        for a in group:
            near[a].update(b for b in group if one_edit(a, b))
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        yield (w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None)


def test_small_table_whole(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in op11_spelling_variants(spark, SMALL).collect())
    assert got == sorted(grouped(counted(docs)))


def check(spark, counts):
    words = spark.createDataFrame([(w, n, 1, "x") for w, n in counts.items()], "word string, n long, pos int, root string")
    got = sorted((tuple(r) for r in spelling.variants(words).collect()), key=lambda r: r[0])
    assert got == sorted(grouped(counts), key=lambda r: r[0])


def test_dense_words(spark):
    rnd = random.Random(1)
    check(spark, {"".join(rnd.choice("abé") for _ in range(rnd.randrange(1, 6))): rnd.randrange(1, 200) for _ in range(250)})


def test_prefixes_long_words_and_ties(spark):
    long = "ab" * 1500
    counts = {"a" * i: 2 ** i for i in range(1, 12)}
    counts |= {long: 8, long + "c": 3, long[:700] + "x" + long[700:]: 20, long[:-1]: 1, "y" + long[1:]: 16, "z" + long[1:]: 16}
    check(spark, counts)
    check(spark, {"single": 4})


def test_words_of_awkward_documents(spark):
    texts = [None, "", "été ÉTÉ×÷", "abcdef-abcdef abcdeF1abcdef", "ABCDEF " * 40, "x" * 3000, "x" * 3000, "naïveĀnaïve " * 3]
    ids = [1, 2, None, 4, None, 6, 6, 8]
    docs = spark.createDataFrame([(i, t, "c", 5) for i, t in zip(ids, texts)], "doc_id long, text string, run string, n int")
    got = {r.word: r.n for r in damaged_words(docs, 3, 1).collect()}
    assert got == counted(zip(ids, texts), 3, 1)
    assert spelling.variants(damaged_words(docs.limit(0))).count() == 0


def test_null_and_repeated_words(spark):
    words = spark.createDataFrame([("house", 3), ("house", 4), ("houses", None), (None, 5), ("", 2)], "word string, n long")
    got = sorted(tuple(r) for r in spelling.variants(words).collect())
    assert got == [("house", None, "house", 7, 1, None), ("houses", "house", "house", 0, 1, 7)]
