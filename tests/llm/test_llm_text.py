"""Word kernel, packets and Elias-Fano sequences."""

import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from chanlytics.llm import packets as P
from chanlytics.llm.eliasfano import EliasFano
from chanlytics.llm.words import ALNUM, LOWER, NOT_SPACE, Words, slices

LOWERED = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
KINDS = {"space": (NOT_SPACE, r"[^\x20\x09-\x0D]+"), "alnum": (ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")}


@pytest.mark.parametrize("kind", KINDS)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAzZ09 \n\té▁-_🙂\x00", max_size=30)), max_size=8))
@settings(max_examples=150, deadline=None)
def test_words_are_the_pattern(kind, texts):
    table, pattern = KINDS[kind]
    words = Words(pa.array(texts, pa.string()), table, LOWER)
    want = [re.findall(pattern, (t or "").translate(LOWERED)) for t in texts]
    assert words.count.tolist() == [len(w) for w in want]
    seen = {}
    for w, h in zip((x for ws in want for x in ws), words.hash.tolist()):
        assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_slices_keep_all_rows():
    batch = pa.RecordBatch.from_pydict({"text": pa.array(["x" * n for n in (5, 0, 100, 3, 3)] + [None])})
    parts = list(slices(batch, "text", 6))
    assert pa.Table.from_batches(parts).to_pydict() == pa.Table.from_batches([batch]).to_pydict()
    assert max(p.num_rows for p in parts) > 1


@given(st.lists(st.integers(0, 2**64 - 1), unique=True, max_size=60).map(sorted))
@settings(max_examples=100, deadline=None)
def test_packets_round_trip(keys):
    a = np.array(keys, np.uint64)
    assert P.unpack_keys(P.pack_keys(a)).tolist() == keys
    cuts = P.shard_cuts(a, 7)
    assert cuts[0] == 0 and cuts[-1] == len(a) and (np.diff(cuts) >= 0).all()
    for s in range(7):
        assert all(int(k) * 7 >> 64 == s for k in a[cuts[s]:cuts[s + 1]])
    assert P.split(P.joined([b"", b"abc", b"d"])) == [b"", b"abc", b"d"]


@given(st.integers(1, 2**40), st.data())
@settings(max_examples=150, deadline=None)
def test_elias_fano(universe, data):
    values = sorted(data.draw(st.sets(st.integers(0, universe - 1), max_size=80)))
    seq = EliasFano(EliasFano.build(np.array(values, np.uint64), universe))
    asked = np.array(values + [min(v + 1, universe - 1) for v in values] + [0, universe - 1], np.uint64)
    if values:
        assert seq.access(np.arange(len(values))).tolist() == values
        assert seq.successor(asked).tolist() == np.searchsorted(np.array(values, np.uint64), asked).tolist()
    assert seq.find(asked).tolist() == [values.index(x) if x in values else -1 for x in asked.tolist()]


def test_elias_fano_reads_a_mapped_file(tmp_path):
    values = np.sort(np.random.default_rng(0).integers(0, 1 << 60, 5000)).astype(np.uint64)
    path = tmp_path / "level"
    path.write_bytes(EliasFano.build(values, 1 << 60))
    seq = EliasFano(np.memmap(path, np.uint8, "r"))
    assert (seq.access(np.arange(5000)) == values).all()
    assert seq.nbytes < 0.95 * values.nbytes


def test_elias_fano_in_pieces():
    """More positions than a piece, in any order: each is found, and each value is read once."""
    from chanlytics.llm import eliasfano

    r = np.random.default_rng(3)
    values = np.sort(r.integers(0, 1 << 40, 3 * eliasfano._PIECE)).astype(np.uint64)
    sequence = EliasFano(EliasFano.build(values, 1 << 40))
    asked = r.permutation(np.concatenate([values, r.integers(0, 1 << 40, 1000).astype(np.uint64)]))
    at = np.searchsorted(values, asked)
    held = values[np.minimum(at, len(values) - 1)] == asked
    assert (sequence.find(asked) == np.where(held, at, -1)).all()
    places, read = r.integers(0, len(values), 2 * len(values)), []
    select = sequence._select
    sequence._select = lambda flip, rank: read.append(len(rank)) or select(flip, rank)
    assert (sequence.access(places) == values[places]).all()
    assert sum(read) == len(values) and max(read) <= eliasfano._PIECE
