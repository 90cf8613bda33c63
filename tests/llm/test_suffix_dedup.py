"""Repeated passages against a plain count of all windows."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from tallyloom.llm import front_coding, suffix_dedup
from tallyloom.llm.front_coding import HEAD, WINDOW, Anchors, anchors, common_prefixes, merged, opened, page, sorted_run


def _block(texts):
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    return data, np.cumsum(sizes), np.cumsum(sizes) - sizes


def _brute(texts):
    """(n_bytes, n_removed, n_spans, kept_sha256) of each text."""
    seen = Counter(t[i: i + WINDOW] for t in texts for i in range(len(t) - WINDOW + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - WINDOW + 1):
            if seen[t[i: i + WINDOW]] > 1:
                gone[i: i + WINDOW] = True
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        out.append((len(t), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def _texts(seed):
    random = np.random.default_rng(seed)
    letters = "abcdefghij klmnopqrsté中"

    def prose(n):
        return "".join(letters[i] for i in random.integers(0, len(letters), n))

    shared = [prose(int(n)) for n in random.integers(150, 420, 5)]
    texts = [prose(int(random.integers(0, 300))) + shared[int(random.integers(5))] + prose(int(random.integers(0, 300)))
             + shared[int(random.integers(5))] for _ in range(40)]
    texts += [texts[0], texts[1], "", prose(199), "x" * 199, "x" * 200, "x" * 900, "ab" * 300, "y" * 201, texts[2] + texts[2]]
    texts += [shared[0][:-1], shared[0][1:], shared[1][10:] + "!"]
    return texts


def test_windows_find_the_same_anchor_wherever_they_stand(monkeypatch):
    texts = [t.encode() for t in _texts(3)]
    data, ends, begins = _block(texts)
    found = anchors(data, ends)
    places = {}
    for a, first, last in zip(found.at.tolist(), found.first.tolist(), found.last.tolist()):
        for i in range(first, last + 1):
            assert i not in places.get("starts", {})
            window = data[i: i + WINDOW].tobytes()
            assert places.setdefault(window, a - i) == a - i
    assert int((found.last - found.first + 1).sum()) == sum(max(0, len(t) - WINDOW + 1) for t in texts)
    whole = sorted(zip(found.at.tolist(), found.first.tolist()))
    monkeypatch.setattr(front_coding, "PIECE", 64)
    pieces = anchors(data, ends)
    assert {a for a, _ in whole} == set(pieces.at.tolist())


def _runs(texts, n):
    runs = []
    for i in range(n):
        data, ends, begins = _block([t.encode() for t in texts[i::n]])
        found = anchors(data, ends)
        runs.append(sorted_run(data, begins, np.searchsorted(ends, found.at, side="right"), found))
    return runs


@pytest.mark.parametrize("n", [1, 2, 3, 7])
def test_loser_tree_gives_all_suffixes_in_order_with_their_prefixes(n):
    runs = [opened(page(r, 0, len(r.suffixes))) for r in _runs(_texts(n), n)]
    found = [(runs[r].suffixes[i], c) for r, i, c in merged(runs)]
    suffixes = [s for s, _ in found]
    assert suffixes == sorted(s for r in runs for s in r.suffixes)
    assert [c for _, c in found] == common_prefixes(suffixes).tolist()


def test_merge_looks_only_beyond_known_prefixes(monkeypatch):
    looks = []
    plain = front_coding._mismatch

    def watched(a, b, known):
        assert a[:known] == b[:known]
        looks.append(known)
        return plain(a, b, known)

    monkeypatch.setattr(front_coding, "_mismatch", watched)
    runs = _runs(_texts(5), 4)
    n = sum(len(r.suffixes) for r in runs)
    assert len(list(merged(runs))) == n
    assert len(looks) < n * 2 and max(looks) >= HEAD


def test_empty_runs():
    none = Anchors(*(np.zeros(0, k) for k in (np.int64, np.int64, np.int64, np.uint64)))
    empty = sorted_run(np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64), none)
    assert list(merged([empty, empty])) == [] and len(front_coding.repeated_windows([empty])) == 0
    assert opened(page(empty, 0, 0)).suffixes == []


@pytest.mark.parametrize(("seed", "block", "part"), [(1, 8 << 20, 24 << 20), (2, 3000, 20_000)])
def test_report_is_brute_force(spark, monkeypatch, seed, block, part):
    monkeypatch.setattr(suffix_dedup, "BLOCK", block)
    monkeypatch.setattr(suffix_dedup, "PART", part)
    texts = _texts(seed)
    docs = spark.createDataFrame([(i, t, 5, "z") for i, t in enumerate(texts)], "doc_id long, text string, n_bytes int, _digest string")
    found = suffix_dedup.repeat_report(docs.repartition(4))
    assert found.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert [tuple(r)[1:] for r in sorted(found.collect())] == _brute([t.encode() for t in texts])


def test_odd_rows_and_kept_bytes(spark, odd, empty):
    rows = odd.collect()
    expected = Counter(zip([r.doc_id for r in rows], _brute([(r.text or "").encode() for r in rows])))
    assert Counter((r[0], tuple(r)[1:]) for r in suffix_dedup.repeat_report(odd).collect()) == expected
    assert suffix_dedup.repeat_report(empty).collect() == []
    for r in suffix_dedup.without_repeats(odd).collect():
        raw = (r.text or "").encode()
        gone = {i for s in r.spans for i in range(s.start, s.end)}
        assert bytes(r.kept) == bytes(c for i, c in enumerate(raw) if i not in gone)
        assert (r.n_bytes, r.n_removed, r["size"]) == (len(raw), len(gone), 7)


def test_a_task_sends_a_text_once(spark):
    docs = spark.createDataFrame([(i, "copy " * 60) for i in range(500)], "doc_id long, text string").coalesce(2)
    rows = suffix_dedup.repeat_report(docs).collect()
    assert {tuple(r)[1:4] for r in rows} == {(300, 300, 1)} and len(rows) == 500
