"""op12 against a plain restatement."""

import collections
import math
import random
import re

from cellscape.llm import quality_rules as Q

DOCS = "doc_id long, text string, lang string, words string, bin int, kept int, _row long"
CLASSES = ("[a-z]", "[A-Z]", "[^\x00-\x7f]", "[#*$%&|<>]", "[.,;:!?'\"()-]", "[0-9]")


def base(text):
    words = [w for w in re.split("[ \t-\r]+", text or "") if w]
    where = collections.defaultdict(list)
    for i in range(len(words) - 2):
        where[tuple(words[i:i + 3])].append(i)
    hit = {p for at in where.values() if len(at) > 1 for i in at for p in (i, i + 1, i + 2)}
    lines = [line for line in (text or "").split("\n") if re.search("[^ \t-\r]", line)]
    chars = "".join(words)
    counts = [len(re.findall(c, chars)) for c in CLASSES]
    return words, counts + [len(chars) - sum(counts)], len(chars), counts[3], len(lines) - len(set(lines)), len(hit)


def distance(p, q):
    def part(x, y):
        return sum(a * math.log2(2 * a / (a + b)) for a, b in zip(x, y) if a > 0)
    return math.sqrt(max(0, (part(p, q) + part(q, p)) / 2))


def judged(docs, rules):
    rows, words, classes = [], collections.defaultdict(collections.Counter), collections.defaultdict(lambda: [0] * 7)
    for doc_id, text, lang in docs:
        w, counts, chars, symbols, dup, rep = base(text)
        failed = len(w) < rules.min_words or 100 * rep > rules.max_repeat_percent * len(w)
        rows.append((doc_id, lang, w, counts, chars, symbols, dup, rep, failed))
        if not failed:
            words[lang].update(w)
            classes[lang] = [a + b for a, b in zip(classes[lang], counts)]
    for doc_id, lang, w, counts, chars, symbols, dup, rep, failed in rows:
        by_class = by_word = None
        if not failed:
            total, all_chars = sum(words[lang].values()), sum(classes[lang])
            if all_chars >= rules.min_reference and chars >= rules.min_chars:
                by_class = distance([c / chars for c in counts], [c / all_chars for c in classes[lang]])
            if total >= rules.min_reference and len(w) >= rules.min_histogram_words:
                common = sorted(words[lang].items(), key=lambda x: (-x[1], x[0]))[:rules.common]
                mine = collections.Counter(w)
                p, q = [mine[x] / len(w) for x, _ in common], [n / total for _, n in common]
                by_word = distance([*p, 1 - sum(p)], [*q, 1 - sum(q)])
        kept = not failed and not (by_class or 0) > rules.max_class_distance and not (by_word or 0) > rules.max_word_distance
        yield (doc_id, len(w), chars, symbols, dup, rep, failed, kept), by_class, by_word


NAMES = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def same(got, want):
    def key(row, *distances):
        return repr((*row, *(d if d is None else round(d, 7) + 0.0 for d in distances)))

    got = sorted(key([r[c] for c in NAMES], r.class_distance, r.word_distance) for r in got)
    want = sorted(key(*w) for w in want)
    assert [(g, w) for g, w in zip(got, want, strict=True) if g != w][:4] == []


def awkward(seed=2):
    rnd = random.Random(seed)
    vocabulary = [f"{rnd.choice('abcdefé')}{rnd.choice('xyzß')}{i % 7}" for i in range(90)]
    docs = []
    for i in range(120):
        lang = ["en", "fr", None, "", "xx"][min(i % 9, 4)]
        text = " ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([3, 49, 50, 80, 300])))
        if i % 10 == 0:
            text = re.sub(" ", "### ", text)
        if i % 11 == 0:
            text = "same again and " * 30 + "\nline\n" * 5 + text[:80]
        docs.append((i if i % 13 else None, text, lang))
    return docs + docs[:3] + [(900, None, "en"), (901, "", None), (902, " \n\t\n", "fr"), (903, "word " * 30_000, "en"), (904, "é" * 50_000, "xx")]


def test_awkward_documents(spark):
    docs = awkward()
    table = spark.createDataFrame([(i, t, lang, "w", 1, 2, 3) for i, t, lang in docs], DOCS)
    for rules in (Q.Rules(min_reference=500, common=20), Q.Rules(min_reference=10 ** 9), Q.Rules(min_reference=1, min_words=1, common=3)):
        same(Q.judge(table, rules).collect(), list(judged(docs, rules)))
    assert Q.judge(table.limit(0)).count() == 0
