import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyloom.llm.words import hash_words, raw_bytes, shingles, split_texts, words_of


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAbZ \t\n\x0b\x0c\r\x1cé▁", max_size=30)), max_size=8))
def test_words_are_those_of_bytes_split(texts):
    found = list(split_texts(pa.array(texts, pa.string())))
    plain = [(t or "").encode().lower().split() for t in texts]
    assert [len(f) for f in found] == [len(p) for p in plain]
    codes = {}
    for f, p in zip(found, plain):
        for h, w in zip(f.tolist(), p):
            assert codes.setdefault(w, h) == h
    assert len(set(codes.values())) == len(codes)


def test_chunks_and_slices_agree():
    texts = pa.array([f"word{i} " * (i % 50) for i in range(300)] + ["y" * 3_000_000, None])
    whole = [h for _, h, _ in words_of(texts)]
    assert np.concatenate(whole).tolist() == np.concatenate(list(split_texts(texts))).tolist()
    part = list(split_texts(texts.slice(7, 20)))
    assert [p.tolist() for p in part] == [p.tolist() for p in list(split_texts(texts))[7:27]]


def test_shingles():
    words = hash_words(*raw_bytes(pa.array(["a b c a b c"])))[0]
    assert len(shingles(words, 3)) == 3
    assert len(shingles(words[:2], 3)) == 1 and len(shingles(words[:0], 3)) == 0
    assert shingles(words[:2], 3)[0] not in shingles(words, 3)
