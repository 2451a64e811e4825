import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from clickwell.llm.packing import RoomTree, UnitTokenizer, pack, plan
from helpers import awkward_rows, frame, prose

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)
UNITS = UnitTokenizer(PATH)


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


def same_ids(texts):
    ids, offsets = UNITS(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        assert ids[offsets[i]:offsets[i + 1]].tolist() == ids_of(t), repr(t)


def test_unit_tokenizer_on_odd_texts():
    same_ids(["", None, "It's John's dog's... isn't it?!", "<|endoftext|> <|ENDOFTEXT|> x<|startoftext|>y.", "á. é",
              " nb sp em", "ΣΑΣ. ΣΑΣ", "İstanbul, İ.", "1,234.56 12:30; ?!", "don't. 'tis. ''..''", "日本語。テスト", "a.́b",
              "x\x1cy\x85z", "Ünï.CODE,text;", "!!!", ".", "'s. 'S, 'll", "ﬁne. Ⅷ½", "\U0001f600. \U0001f468‍\U0001f469"])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from(" \n\t.,'sStTaAéÉ0<|>!?́ Σ"), st.characters(exclude_categories=("Cs",))), max_size=40),
                max_size=4))
def test_unit_tokenizer_equals_tokenizer(texts):
    same_ids(texts)


def brute_best_fit(lengths, capacity):
    rooms, out = [], []
    for length in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= length]
        if fits:
            at = rooms.index(min(fits))
        else:
            rooms.append(capacity)
            at = len(rooms) - 1
        out.append((length, capacity - rooms[at]))
        rooms[at] -= length
    return sorted(rooms), sorted(out)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=120), st.integers(40, 60))
def test_plan_is_best_fit_decreasing(lengths, capacity):
    counts = {x: lengths.count(x) for x in lengths}
    used, placed = {}, []
    for length, a, b, first, offset in plan(counts, capacity):
        for k in range(b - a):
            assert used.get(first + k, 0) == offset  # gapless
            used[first + k] = offset + length
            placed.append((length, offset))
    assert sorted(x for x, _ in placed) == sorted(lengths)
    rooms, want = brute_best_fit(lengths, capacity)
    assert sorted(capacity - u for u in used.values()) == rooms and sorted(placed) == want


def test_room_tree_finds_the_tightest():
    rng = random.Random(0)
    tree, rooms = RoomTree(100), []
    for _ in range(500):
        if rooms and rng.random() < 0.5:
            need = rng.randint(0, 100)
            want = min((r for r in rooms if r >= need), default=None)
            assert tree.tightest(need) == want
            if want is not None:
                tree.take(want)
                rooms.remove(want)
        else:
            r = rng.randint(0, 100)
            tree.put(r, (0, 1))
            rooms.append(r)


@pytest.mark.parametrize("capacity", [4096, 64])
def test_pack(spark, capacity):
    rng = random.Random(9)
    rows = [r for r in awkward_rows() if r[0] is not None][:-2] + [(1000 + i, prose(rng, rng.randint(1, 90)), None, None, 0) for i in range(60)]
    got = pack(frame(spark, rows), PATH, capacity=capacity).collect()
    pieces = {(r.doc_id, r.piece): r for r in got}
    assert len(pieces) == len(got)
    for i, t, *_ in rows:
        own = ids_of(t) + [1]
        for k, s in enumerate(range(0, len(own), capacity)):
            r = pieces.pop((i, k))
            part = np.array(own[s:s + capacity], "<u4")
            assert (r.start, r.length, r.ids_crc32) == (s, len(part), zlib.crc32(part.tobytes()))
    assert not pieces
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(by_sequence) == len(brute_best_fit([r.length for r in got], capacity)[0])


def test_pack_defined_cases(spark):
    assert pack(frame(spark, []), PATH).count() == 0
    got = pack(frame(spark).withColumnsRenamed({"lang": "piece", "source": "length"}), PATH)
    assert got.select("doc_id").distinct().count() == len({r[0] for r in awkward_rows()})
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
