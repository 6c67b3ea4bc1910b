import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from voltstream.llm.packing import cut_pieces, fullest, pack, plan_bins
from voltstream.llm.tokens import Encoder, count_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
EXACT = Tokenizer.from_file(PATH)
PARTS = ["a", "the ", "Ä", "  ", "\n", "\t", "'s", "don't", "12", "é", "!!", "<|endoftext|>", " ", "漢字", "\x85", "\x1c", "😀", "--", "²"]


def exact(text):
    return EXACT.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("chunk, overlap", [(64, 4), (1 << 16, 1 << 10), (17, 16)])
def test_spliced_ids_equal_whole_ids(chunk, overlap):
    tokenizer, rng = Encoder(PATH, chunk, overlap), random.Random(1)
    texts = ["".join(rng.choices(PARTS, k=rng.randrange(120))) for _ in range(400)]
    texts += ["x" * 1000, "ab " * 300, "é" * 500, "<|endoftext|>" * 50, "漢" * 300 + " a b", " " * 300, ""]
    for text in texts:
        assert list(tokenizer.ids(text)) == exact(text)


def test_letters_read_alike_by_both_libraries():
    tokenizer = Encoder(PATH)
    for first in range(0, 0x600, 16):
        text = " ".join(f"{chr(c)}a {chr(c)}{chr(c)}1" for c in range(first, first + 16))
        assert list(tokenizer.ids(text)) == exact(text)


def test_sentence_pieces_and_other_json():
    for name in ("piece_bpe_32k.model", "word_bpe_49k.json"):
        path = public_tokenizers.path(name)
        ids = Encoder(path).ids("Some words, and some more")
        assert len(ids) > 4
    assert list(ids) == Tokenizer.from_file(path).encode("Some words, and some more", add_special_tokens=False).ids


ROWS = [(1, "one two", 5), (1, "one two", 5), (None, "x" * 300, 1), (2, None, 2), (3, "", 3), (4, "word " * 900, 4)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, "doc_id BIGINT, text STRING, n_tokens BIGINT")


def test_counts_of_odd_rows(odd):
    got = sorted(map(tuple, count_tokens(odd, PATH, limit=2, chunk=64, overlap=8).collect()), key=repr)
    want = [(k, len((t or "").encode()), len(exact(t)), len(exact(t)) > 2) for k, t, _ in ROWS]
    assert got == sorted(want, key=repr)
    assert count_tokens(odd.where("false"), PATH).collect() == []


def check_packing(rows, texts, capacity):
    """Every sequence is gapless and fits; every text's pieces make up its ids."""
    sequences, pieces = {}, {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces.setdefault(r.doc_id, []).append(r)
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    for key, text in texts:
        ids = np.array([*exact(text), 0], "<u4")
        own = [r for r in pieces[key] if zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32]
        assert sum(r.length for r in {(r.piece, r.start): r for r in own}.values()) == len(ids)
        for r in own:
            assert r.piece == 0 or r.length == capacity
    return sequences


@pytest.mark.parametrize("capacity", [2, 64, 2048])
def test_packing_of_odd_rows(odd, capacity):
    rows = pack(odd, PATH, capacity).collect()
    check_packing(rows, [(k, t) for k, t, _ in ROWS], capacity)
    assert pack(odd.where("false"), PATH, capacity).collect() == []


def test_packing_of_the_whole_table(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    rows = pack(docs, PATH).collect()
    sequences = check_packing(rows, [(r.doc_id, r.text) for r in docs.collect()], 2048)
    # As good as can be: the ids alone fill all sequences but a few.
    assert len(sequences) <= -(-sum(r.length for r in rows) // 2048) + 2


def test_cut_pieces_have_the_remainder_first(odd):
    lengths = [r.length for r in cut_pieces(odd.where("doc_id = 4"), PATH, 400).orderBy("piece").collect()]
    assert lengths[1:] == [400] * (len(lengths) - 1) and 0 < lengths[0] <= 400


def test_fullest_is_the_fullest():
    rng = random.Random(3)
    for _ in range(200):
        counts = {rng.randint(1, 30): rng.randint(1, 4) for _ in range(rng.randint(1, 6))}
        chosen = fullest(counts, 40)
        assert all(counts[n] >= c for n, c in chosen.items()) and chosen[max(counts)] >= 1
        sums = {max(counts)}
        for n, c in counts.items():
            copies = c - (n == max(counts))
            sums |= {s + n * k for s in sums for k in range(copies + 1)}
        assert sum(n * c for n, c in chosen.items()) == max(s for s in sums if s <= 40)


def test_plan_places_every_piece_once():
    counts = {n: n % 7 + 1 for n in range(1, 200)}
    placed = dict.fromkeys(counts, 0)
    for chosen, times in plan_bins(counts, 256):
        assert sum(n * c for n, c in chosen.items()) <= 256
        for n, c in chosen.items():
            placed[n] += c * times
    assert placed == counts
