import random
import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from scolaria.llm.shared import _KEPT, drop_kept
from scolaria.llm.packing import SumOfSquares, pack_documents
from scolaria.llm.token_ids import ChunkEncoder, encoder_of
from scolaria.llm.token_store import WaveletMatrix, batches_of, open_shard, shard_bytes, store_tokens
from tests.llm.conftest import CLASHES, ODD

WORD, BYTE = (public_tokenizers.path(name) for name in ("word_bpe_49k.json", "byte_bpe_50k.json"))


@lru_cache
def plain(path):
    tokenizer = Tokenizer.from_file(path)  # as it comes, with no switch set
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


PIECES = ["a", "b", "'s", "'", "S", "The", "tx", "!", ".", '"', "é", "É", "ß", "×", "ÿ", "1", "2", " ", "  ", "\n", "\t", "\u3000", "\u00a0", "\x1c", "\x85", "e\u0301", "\u0301", "İ", "Σ", "ς",
          "<", "|", ">", "&", "\0", "😀", "</w>", "Ġ", "Ā", "½", "²", "ﬁ", "<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|endoftext", "w"]


@pytest.mark.parametrize("path", [WORD, BYTE])
@settings(max_examples=200, deadline=None)
@given(texts=st.lists(st.lists(st.sampled_from(PIECES), max_size=25).map("".join), max_size=5))
def test_chunks_encode_like_whole_texts(path, texts):
    ids, starts = encoder_of(path).encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:])] == [plain(path)(text) for text in texts]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_special_tokens_are_those_of_the_library(path):
    texts = ["a <|endoftext|> b", "x<|endoftext|>y", "<|endoftext|><|endoftext|>", " <|endoftext|>\n", "A <|ENDOFTEXT|> b", "<|startoftext|> a"]
    ids, starts = ChunkEncoder(path).encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:])] == [plain(path)(text) for text in texts]
    assert plain(path)("<|endoftext|>")[-1] in ids


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_every_given_text(path, sf_dir, spark):
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    encoder = ChunkEncoder(path)
    assert encoder.pattern is not None  # the quick way is taken
    ids, starts = encoder.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:])] == [plain(path)(text) for text in texts]


def test_one_encoder_is_kept():
    first = encoder_of(WORD)
    assert encoder_of(WORD) is first and encoder_of(BYTE) is encoder_of(BYTE) and encoder_of(WORD) is not first
    drop_kept()
    assert _KEPT == {}


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_many_words_are_one_text(path):
    """15 000 words, each with a comma and without: the model sees every word once, all in one text."""
    encoder, seen = ChunkEncoder(path), []
    model = encoder.model

    class Counted:
        def encode_batch_fast(self, texts, **more):
            seen.extend(texts)
            return model.encode_batch_fast(texts, **more)

    encoder.model = Counted()
    words = ["".join(chr(97 + i // 26**k % 26) for k in range(4)) for i in range(15_000)]
    text = " ".join([*words, *(f"{word}," for word in words)])
    ids, _ = encoder.encode([text])
    assert ids.tolist() == plain(path)(text) and len(seen) == 1 and len(seen[0].split()) < 2 * 15_010


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_a_word_is_learned_once_whatever_signs_follow(path):
    """Words with 40 endings: what is remembered grows with the words and the endings, not with both."""
    encoder, words = ChunkEncoder(path), [f"{a}{b}rd" for a in "abcdefghij" for b in "klmnopqrst"]
    ends = ["".join(pair) for pair in zip("!%&,.:;?" * 5, "*" * 8 + "%" * 8 + "." * 8 + "&" * 8 + "!" * 8)]
    text = " ".join(["", *(word + end for word in words for end in ends)])
    ids, _ = encoder.encode([text])
    assert ids.tolist() == plain(path)(text) and len(encoder.chunks.codes) <= len(words) + len(ends) + 5


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_signs_and_letters_in_any_order(path):
    r = random.Random(5)
    texts = ["".join(r.choices("abS'stl!.*_<>|09 \n\t\u0301\u0338é×\u00a0\u3000", k=r.randint(0, 30))) for _ in range(4000)]
    texts[::97] = [f"{text}<|endoftext|>{text}" for text in texts[::97]]
    ids, starts = encoder_of(path).encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:])] == [plain(path)(text) for text in texts]


def test_chunks_are_forgotten_and_learned_again():
    encoder = ChunkEncoder(WORD, max_chunks=2, max_chars=9)
    for text in ("one two three", "four five", "one two six", None, ""):
        ids, _ = encoder.encode([text])
        assert ids.tolist() == plain(WORD)(text)


@settings(max_examples=60, deadline=None)
@given(ids=st.lists(st.integers(0, 70000) | st.integers(0, 3), max_size=1500))
def test_wavelet_matrix(ids):
    keys, lengths, matrix = open_shard(shard_bytes([5, None], np.array([len(ids), 0]), np.array(ids, np.uint32)))
    assert keys == [5, None] and lengths.tolist() == [len(ids), 0] and matrix.ids().tolist() == ids
    for place in range(0, len(ids), 97):
        assert matrix.access(place) == ids[place]
    for value in {*ids[:5], 1, 99999}:
        places = [i for i, x in enumerate(ids) if x == value]
        assert matrix.count(value) == len(places)
        for k in range(0, len(places), 41):
            assert matrix.occurrence(value, k) == places[k]
        with pytest.raises(IndexError):
            matrix.occurrence(value, len(places))


def test_planes_are_bits():
    matrix = WaveletMatrix.of(np.arange(5000) % 300)
    assert len(matrix.words) == 9 and sum(words.nbytes for words in matrix.words) <= 9 * (5000 / 8 + 64)


def test_batches():
    assert list(batches_of(["aa", None, "bbb", "c" * 9, "d"], 5)) == [slice(0, 3), slice(3, 4), slice(4, 5)]
    assert list(batches_of([])) == []


def test_store_round_trip(docs_of):
    ids = plain(WORD)
    for shard_tokens in (1, 7, 1 << 20):
        got = store_tokens(docs_of(ODD, *CLASHES).repartition(3), WORD, shard_tokens=shard_tokens).collect()
        got.sort(key=lambda r: r.start)
        assert [r.doc_id for r in got] == sorted((i for i, _ in ODD), key=lambda i: (i is not None, i))
        start = 0
        texts = {}
        for i, text in ODD:
            texts.setdefault(i, []).append(text)
        for r in got:
            assert r.start == start
            start += r.n_tokens
            assert any(crc([*ids(t), 2]) == r.ids_crc32 and len(ids(t)) + 1 == r.n_tokens for t in texts[r.doc_id])
    assert store_tokens(docs_of([]), WORD).collect() == []


def padding(windows, window):
    """Ids of padding over all windows; a window that holds a power of two needs none."""
    sizes = [sum(len(ids) for *_, ids, _ in pieces) for pieces in windows]
    assert all(0 < size <= window for size in sizes)
    return sum(window - size for size in sizes if size & (size - 1))


@settings(max_examples=80, deadline=None)
@given(sizes=st.lists(st.integers(1, 70), max_size=60), most=st.integers(1, 12))
def test_every_id_in_one_piece(sizes, most):
    packer = SumOfSquares(window=16, max_open=most)
    windows = [w for i, size in enumerate(sizes) for w in packer.add(i, np.arange(size, dtype=np.uint32))]
    windows += packer.flush()
    seen = {}
    for pieces in windows:
        for i, start, ids, total in pieces:
            assert total == sizes[i] and ids.tolist() == list(range(start, start + len(ids)))
            seen.setdefault(i, []).extend(ids.tolist())
    assert {i: sorted(ids) for i, ids in seen.items()} == {i: list(range(size)) for i, size in enumerate(sizes)}
    assert padding(windows, 16) == 0


def test_level_of_least_squares():
    """The level that is taken leaves no greater sum of squares than any other."""
    random = np.random.default_rng(1)
    packer = SumOfSquares(window=32, max_open=10**6)
    for i in range(400):
        size = int(random.integers(1, 32))

        def after(level):
            counts = packer.levels.copy()
            if level:
                counts[level] -= 1
            if level + size < 32:
                counts[level + size] += 1
            return int((counts[1:32] ** 2).sum())

        options = [level for level in range(32 - size + 1) if level == 0 or packer.levels[level]]
        assert after(packer._level(size)) == min(map(after, options))
        list(packer.add(i, np.zeros(size, np.uint32)))


def test_pieces_of_a_table(docs_of):
    ids = plain(BYTE)
    rows = pack_documents(docs_of(ODD, *CLASHES).repartition(3), BYTE).collect()
    texts = {}
    for i, text in ODD:
        texts.setdefault(i, []).append([*ids(text), 1])
    assert sum(r.length for r in rows) == sum(len(x) for found in texts.values() for x in found)
    for r in rows:
        assert any(len(x) == r.doc_tokens and crc(x[r.start : r.start + r.length]) == r.ids_crc32 for x in texts[r.doc_id])
    places = {}
    for r in sorted(rows, key=lambda r: r.offset):
        assert r.offset == places.get(r.sequence_id, 0)
        places[r.sequence_id] = r.offset + r.length
    assert max(places.values()) <= 2048
    assert pack_documents(docs_of([]), BYTE).collect() == []
