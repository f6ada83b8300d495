"""Hard negatives, line labelling and phrase mining against brute force."""

import itertools
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tributary.llm import collocations, hard_negatives, line_rules


def mined(rows, every, n_pos, n_neg, low=30, high=90):
    """Brute force over (vec_id, vector, label) rows, with Python integers."""
    seen = {(i, tuple(v), y) for i, v, y in rows if i is not None and y is not None and v and all(x is not None and np.isfinite(x) for x in v)}
    ints = [(i, [int(np.floor(256 * float(x))) for x in v], y, (i, v, y)) for i, v, y in seen]
    out = []
    for i, v, y, me in ints:
        if i % every:
            continue
        s = sorted((-sum(a * b for a, b in zip(v, w)), j, z) for j, w, z, other in ints if other != me and len(w) == len(v))
        for p, j, _ in [t for t in s if t[2] == y][:n_pos]:
            ok = [t for t in s if t[2] != y and low * -p <= 100 * -t[0] <= high * -p][:n_neg]
            out += [(i, j, r, k, -p, -n) for r, (n, k, _) in enumerate(ok, 1)]
    return sorted(out)


def vectors(n=330, dim=19, seed=5):
    rng = np.random.default_rng(seed)
    v = np.round(rng.standard_normal((n, dim)) + 0.6, 1)
    v[100:180] = v[40]                                          # one vector that a quarter share
    rows = [(i, x.tolist(), int(rng.integers(0, 3))) for i, x in enumerate(v)]
    rows += [(None, v[0].tolist(), 1), (20, None, 1), (400, [], 1), (410, v[1].tolist(), None), (420, [float("nan")] * dim, 1),
             (430, [None] + [1.0] * (dim - 1), 0), (440, [float("inf")] * dim, 0), (450, [1.0, 2.0], 0), (451, [2.0, 2.0], 1), (460, [1.0, 2.0], 0)]
    return rows + rows[:30] + [(7, v[9].tolist(), 2)]


VEC = "vec_id long, embedding array<double>, label int, uid string, dim int, n string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, y, "u", 1, "n") for i, v, y in rows], VEC)


def test_hard_negatives_match_brute_force(spark):
    rows = vectors()
    got = hard_negatives.mine(frame(spark, rows), F.col("label"), every=10, n_positives=3, n_negatives=4, block=50, anchor_block=9)
    want = mined(rows, 10, 3, 4)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 100
    assert hard_negatives.mine(frame(spark, rows).limit(0), F.col("label")).count() == 0
    one = frame(spark, [(0, [1.0, 1.0], 1)])
    assert hard_negatives.mine(one, F.col("label")).count() == 0


def test_hard_negatives_with_wide_components(spark):
    """Components that need 64 bits, and planes beyond them."""
    for size in (1e4, 1e6):
        rows = [(i, [size * (i % 5) + 0.25, -size, 3.0 * i], i % 2) for i in range(20)]
        got = hard_negatives.mine(frame(spark, rows), F.col("label"), every=5, n_positives=2, n_negatives=3)
        assert sorted(map(tuple, got.collect())) == mined(rows, 5, 2, 3)
    huge = np.array([[1e30, -3.0], [2.5, -1e25]])
    ints = hard_negatives.integers(huge)
    product = hard_negatives.scores(hard_negatives.bit_planes(ints), ints)
    assert product.tolist() == [[sum(a * b for a, b in zip(x, y)) for y in ints.tolist()] for x in ints.tolist()]


def test_hard_negatives_pair_blocks_without_broadcast(spark, monkeypatch):
    """Anchors that meet every block are not multiplied into a table for the
    driver, and a task returns the first rows of all its blocks only."""
    rows = [(i, v, y) for i, v, y in vectors(seed=6) if i is not None]
    df = frame(spark, rows).coalesce(1)
    plans, stage = [], hard_negatives.stage

    def seen(staged, *size):
        plans.append(staged._jdf.queryExecution().executedPlan().toString())
        return stage(staged, *size)
    monkeypatch.setattr(hard_negatives, "stage", seen)
    out = hard_negatives.mine(df, F.col("label"), every=10, n_positives=3, n_negatives=4, block=20, anchor_block=5)
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert sorted(map(tuple, out.collect())) == mined(rows, 10, 3, 4)
    met = [p for p in plans if p.count("MapInArrow")]
    assert len(met) == 2 and all("CartesianProduct" in p and "Broadcast" not in p for p in met)


def test_best_keeps_the_first_rows_of_each_group():
    rng = np.random.default_rng(9)
    best, rows = hard_negatives.Best(3), []
    for _ in range(40):
        part = [rng.integers(0, 50, 900), rng.choice([-2 ** 63, -5, 0, 7, 2 ** 63 - 1], 900), rng.integers(-4, 4, 900), rng.integers(0, 2 ** 40, 900)]
        best.add(*part)
        assert best.n <= 10_000 + 5 * 150
        rows += zip(*(c.tolist() for c in part), strict=True)
    want = [r for g in range(50) for r in sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2], r[3]))[:3]]
    assert list(zip(*(c.tolist() for c in best.first()), strict=True)) == want
    assert [len(c) for c in hard_negatives.Best(3).first()] == [0] * 4


def test_scores_are_the_products():
    rng = np.random.default_rng(1)
    for dim, most in ((1, 3), (8, 300), (13, 70000), (64, 200)):
        a, c = rng.integers(-most, most + 1, (7, dim)), rng.integers(-most, most + 1, (700, dim))
        assert np.array_equal(hard_negatives.scores(hard_negatives.bit_planes(c), a), c @ a.T)
    zero = np.zeros((2, 3), np.int64)
    assert not hard_negatives.scores(hard_negatives.bit_planes(zero), zero).any()


TEXTS = ["", None, " \t\n ", "one", "a b\na b\n\na b \n", "The same eight words come again in here now. " * 6, "été " * 25, "x" * 5000 + " y",
         "| a | b |\n" * 30, "\n".join(f"Line {i} tells of day {i} when {i} men came, and it ends with {i}." for i in range(900)),
         "人们常说这条河有两个源头，但是地图上只有一个。\n" * 3, "a\x00b \x85 c\u2028d &*#$%<>|" * 9, "The river rises in the spring, and the farmers who live "
         "there move their cattle to the hills until the water falls again.\nHome | About | Contact"]


def base_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i:i + 8])].append(i)
    hit = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    failed = len(words) < 20 or 100 * len(hit) > 30 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), sum(x in lines[:i] for i, x in enumerate(lines)), len(hit), failed)


def test_line_rules_counts_match_brute_force(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(TEXTS)] + [(None, TEXTS[5], "x", 1), (5, TEXTS[5], "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string, n_words int")
    got = line_rules.rules(df).collect()
    key = lambda r: (r[0] is None, *r)
    want = [(i, *base_counts(t)) for i, t, *_ in rows]
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got), key=key) == sorted(want, key=key)
    by = {r.doc_id: r for r in got}
    assert not by[5].kept and not by[8].kept and by[9].kept and by[12].kept and not any(r.kept and r.base_failed for r in got)
    assert 0.7 < by[12].content_share < 1
    assert line_rules.rules(df.limit(0)).count() == 0


def test_viterbi_matches_every_sequence():
    rng = np.random.default_rng(4)
    lengths = [1, 2, 3, 7, 1, 9, 5]
    doc = np.repeat(np.arange(len(lengths)) * 2, lengths)
    emit, link = rng.standard_normal((len(doc), 2)), rng.standard_normal((2, 2))
    for cut in (0, 4, 100):                                     # one by one, both ways, side by side
        got = line_rules.decode(emit, doc, link, cut)
        for d in np.unique(doc):
            e = emit[doc == d]
            value = lambda s, e=e: sum(e[i, y] for i, y in enumerate(s)) + sum(link[a, b] for a, b in itertools.pairwise(s))
            assert max(itertools.product((0, 1), repeat=len(e)), key=value) == tuple(got[doc == d])
    assert not len(line_rules.decode(emit[:0], doc[:0], link))
    assert not line_rules.decode(np.zeros((4, 2)), np.array([1, 1, 2, 2]), np.zeros((2, 2))).any()  # ties: content


def test_field_learns_its_table_and_maximises_its_likelihood():
    weights, link = line_rules.train()
    texts, states = line_rules.labelled()
    x = line_rules.lines_of(texts)
    hashes = line_rules.SpanHash(x["raw"])
    values = line_rules.features(x, hashes, line_rules.equal_earlier(x, hashes))
    assert values.shape[1] == len(line_rules.FEATURES)
    assert np.mean(line_rules.decode(values @ weights.T, x["doc"], link) == np.concatenate(states)) > 0.95

    def loss(weights, link):
        """Penalised, by summing over every sequence of the shorter documents."""
        total = 0.0
        for d, y in enumerate(states):
            e = values[x["doc"] == d] @ weights.T
            all_of = [sum(e[i, s] for i, s in enumerate(p)) + sum(link[a, b] for a, b in itertools.pairwise(p)) for p in itertools.product((0, 1), repeat=len(y))]
            total += sum(e[i, s] for i, s in enumerate(y)) + sum(link[a, b] for a, b in itertools.pairwise(y)) - np.logaddexp.reduce(all_of)
        return -total / len(x["doc"]) * 4 + line_rules.PENALTY / 20 * ((weights ** 2).sum() + (link ** 2).sum())
    rng = np.random.default_rng(0)
    for _ in range(3):
        step = rng.standard_normal(weights.shape) * 0.2, rng.standard_normal((2, 2)) * 0.2
        assert loss(weights, link) < loss(weights + step[0], link + step[1])


def test_line_rules_agree_with_quality_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = line_rules.rules(docs).join(labels.where("quality is not null").dropDuplicates(["doc_id"]), "doc_id").where("not base_failed").collect()
    assert np.mean([r.kept for r in got if r.quality == 1]) > 0.97
    assert np.mean([not r.kept for r in got if r.quality == 0]) > 0.9


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def best_phrases(rows, longest, least, inside, most):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for m in range(1, longest + 1):
                counts[lang].update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, f in counts.items():
        cands = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        hidden = {p[i:i + m] for p, a in cands.items() for m in range(2, len(p)) for i in range(len(p) - m + 1) if 100 * a >= inside * cands[p[i:i + m]]}
        kept = []
        for p, a in cands.items():
            if p not in hidden:
                score, _, left, right = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, r, p.decode(), -a, x, y, totals[lang], -s) for r, (s, a, p, x, y) in enumerate(sorted(kept)[:most], 1)]
    return sorted(out)


def phrase_rows():
    rng = np.random.default_rng(8)
    words = ["the", "New", "york", "a", "of", "été", "x\x85y", "日本", "Zoë's", "city", "w" * 120, "(is)", "\x00"]
    rows = []
    for i in range(150):
        w = [words[min(int(x), len(words) - 1)] for x in rng.exponential(3, rng.integers(0, 60))]
        sep = rng.choice([" ", "  ", "\t", ", ", ". ", " \n", "\r\n", " ; "], len(w), p=[.6, .1, .1, .05, .05, .04, .03, .03])
        rows.append((["en", "de", None, "a\nb", ""][i % 5 if i % 2 else 0], "".join(x + y for x, y in zip(w, sep, strict=True))))
    return rows + [("en", "new york city " * 40), ("en", None), ("en", ""), (None, " ,, \t"), ("xx", "once only")] + [("en", "A common line, again and again.")] * 60


def test_collocations_match_brute_force(spark):
    rows = phrase_rows()
    df = spark.createDataFrame([(a, b, "x", 1) for a, b in rows], "lang string, text string, phrase string, rank int")
    for longest, least, inside, most, wave in ((3, 10, 50, 2000, 500_000), (4, 3, 60, 7, 40)):
        got = collocations.mine(df, longest, least, inside, most, wave_size=wave)
        assert sorted(map(tuple, got.collect())) == best_phrases(rows, longest, least, inside, most)
    assert collocations.mine(df.limit(0)).count() == 0
    assert collocations.mine(df.where("lang = 'xx'")).count() == 0


def test_collocations_take_the_best_of_large_groups(spark):
    df = spark.range(5000).selectExpr("if(id % 3 = 0, 'a', 'b') g", "cast(id as string) phrase", "id % 50 s")
    order = [F.col("s").desc(), F.col("phrase")]
    want = collocations.top_of_each(df, "g", order, 20).collect()
    assert len(want) == 40 and sorted(collocations.top_of_each(df, "g", order, 20, at_once=100).collect()) == sorted(want)


def test_double_array_accepts_its_keys_only():
    rng = np.random.default_rng(2)
    keys = sorted({bytes(rng.integers(0, 256 if i % 3 else 3, rng.integers(1, 9)).astype(np.uint8)) for i in range(3000)} | {b"a" * 300, b"a" * 299})
    cells, accepting = collocations.double_array(pa.array(keys, pa.binary()))
    tried = keys + [k + b"x" for k in keys] + [k[:-1] for k in keys if len(k) > 1] + [bytes(rng.integers(0, 256, 4).astype(np.uint8)) for _ in range(500)]
    text, size = np.frombuffer(b"".join(tried), np.uint8), np.array([len(k) for k in tried])
    ends = np.cumsum(size)
    got = collocations.accepted(cells, accepting, text, ends - size, ends, np.zeros(len(tried), np.int64))
    place = {k: i for i, k in enumerate(keys)}
    assert sorted(got) == sorted(place[k] for k in tried if k in place)
