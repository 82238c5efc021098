"""Paragraphs of short texts are found many texts at once, with what each text has by itself."""
import random

import numpy as np
import pyarrow as pa
import pytest

from feedcat.llm import substring_dedup as S
from feedcat.llm.common import WordHash


class Docs:
    """What ``band_keys`` asks of a table; gives back what runs in a task."""

    def select(self, *cols):
        return self

    def mapInArrow(self, rows_of, schema):  # noqa: N802
        return rows_of


def odd_texts():
    rng = random.Random(8)
    gaps = [" ", " ", " ", "\n", "\n\n", "\r\n", "\x0b", "   "]
    say = lambda n: "".join(rng.choice(["a", "Bb", "é", f"w{rng.randrange(50)}"]) + rng.choice(gaps) for _ in range(n))
    texts = [say(rng.choice([1, 3, 4, 5, 8, 19, 20, 21, 40, 300])).encode() for _ in range(400)]
    texts += [None, b"", b"\n", b"a" * 70_000, "end of words ".encode() * 9000, " ".join(f"u{i}" for i in range(20_000)).encode()]
    rng.shuffle(texts)
    return texts


def test_short_texts_are_hashed_together(monkeypatch):
    calls = []

    class Counted(WordHash):
        def spans(self, text):
            calls.append(len(text or b""))
            return super().spans(text)

    monkeypatch.setattr(S, "WordHash", Counted)
    texts = [" ".join(f"word{i}x{j}" for j in range(100)) for i in range(500)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    got, = S.band_keys(Docs())(iter([batch]))
    assert got.num_rows >= 500 * S.BANDS
    assert len(calls) < 20, len(calls)  # 0.5 MB of texts; one call for each text before
    assert max(calls) < 2 * S.TOGETHER


@pytest.mark.parametrize("together", [1, 1 << 12, 1 << 16])
def test_a_group_has_what_its_texts_have(monkeypatch, together):
    monkeypatch.setattr(S, "TOGETHER", together)
    texts, known = odd_texts(), WordHash()
    ranges = list(S.groups(texts))
    assert [i for r in ranges for i in range(*r)] == list(range(len(texts)))
    got, want = [], []
    for i, j in ranges:
        starts, ends, s, bounds = S.paragraphs(texts[i:j], known)
        first, last = S.stretches(s, bounds)
        sums = S.digests(s, np.concatenate([starts, first]), np.concatenate([ends, last]))
        own = S.text_of(np.concatenate([starts, first]), bounds)
        got += zip(own + i, np.concatenate([starts, first]) - bounds[own], np.concatenate([ends, last]) - bounds[own], sums.tolist())
        keys = []
        for k in range(i, j):
            a, b, alone, _ = S.paragraphs([texts[k]], known)
            first, last = S.stretches(alone)
            want += zip([k] * (len(a) + len(first)), [*a, *first], [*b, *last], S.digests(alone, np.array([*a, *first], int), np.array([*b, *last], int)).tolist())
            keys += set(S.bands(alone, a, b).ravel().tolist()) | set(S.stretch_keys(S.digests(alone, first, last)).tolist())
        assert sorted(S.keys_of(texts[i:j], known).tolist()) == sorted(keys)
    assert sorted(got) == sorted(want) and len(got) > 1000
    assert S.keys_of([], known).tolist() == [] == list(S.groups([]))
