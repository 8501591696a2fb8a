"""Encoding, packing and addressable codes against the library and by round trips."""

import itertools
import zlib
from collections import defaultdict

import numpy as np
import pytest

from newsloom.llm import dac, packing
from newsloom.llm.encoding import Encoder, public_vocabulary

from .helpers import by, no_documents, odd_documents

tokenizers = pytest.importorskip("tokenizers")


def library(texts):
    tokenizer = tokenizers.Tokenizer.from_file(public_vocabulary())
    return [np.array([*e.ids, 1], "<u4") for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_encoder_equals_the_library():
    texts = [
        "Ana's, it's. l'été, “x”, a.b,c 1,2. <|endoftext|> <|ENDOFTEXT|> ,'s word,'s é. x y　z 10. a.. ,.", "", "  ",
        "\x1c\x1f a\x85b", "ΣΑΣ, İ. ẞ. x́, y", "don't, DON'T, we'll. they've,", "a,b, a,, b.. c.,",
    ]
    encoder = Encoder(public_vocabulary(), words=5)
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.many([t.encode() for t in texts])] == [x.tolist() for x in library(texts)]


def ids_of(encoder, texts):
    return [np.frombuffer(x, "<u4").tolist() for x in encoder.many([t.encode() for t in texts])]


def test_encoder_cuts_symbols_and_accents_as_the_library():
    texts = [
        "word... (word) word!?\" don't... it's), 'tis' $$$ a,b.) <|endoftext|>. x<|endoftext|>,, é!!! ß\"",
        "\u0958. \u0958!? \u0915. \u212b. İ.", "T\u0344x T\u0308 t\u0308 J\u030c. H\u0331, w\u030a W\u030a",
        "\x01 a\x01b, x \x01\x01 y", "\u3000 \x85 x\u3000, \u0301a",
    ]
    for words in (5, 1000):
        encoder = Encoder(public_vocabulary(), words=words)
        for _ in range(2):
            assert ids_of(encoder, texts) == [x.tolist() for x in library(texts)]


def test_new_words_are_encoded_together_and_without_their_symbols():
    class Counting:
        def __init__(self, tokenizer):
            self.tokenizer, self.texts = tokenizer, []

        def encode_batch_fast(self, texts, **options):
            self.texts += texts
            return self.tokenizer.encode_batch_fast(texts, **options)

    encoder = Encoder(public_vocabulary())
    encoder._tokenizer = counting = Counting(encoder._tokenizer)
    words = ["".join(x) for x in itertools.product("abcdefgh", repeat=4)]
    text = " ".join(word + end for word in words for end in (",", "!?", '..."', ""))
    assert ids_of(encoder, [text]) == [x.tolist() for x in library([text])]
    assert len(counting.texts) < 20 and sum(x.split().count("abcd") for x in counting.texts) == 1


def test_file_round_trip_and_random_access():
    random = np.random.default_rng(3)
    ids = np.concatenate([random.integers(0, 1 << int(b), 500) for b in random.integers(1, 32, 40)]).astype(np.uint32)
    documents = [(5, 0), (None, 7), (9, len(ids) - 7)]
    file = dac.File(dac.encode_file(ids, documents))
    assert len(file) == len(ids) and file.documents == [5, None, 9] and file.starts.tolist() == [0, 0, 7, len(ids)]
    for at in random.integers(0, len(ids), 300):
        assert file.get(int(at)) == ids[at]
    for a, b in random.integers(0, len(ids) + 1, (200, 2)):
        assert file.slice(int(min(a, b)), int(max(a, b))).tolist() == ids[min(a, b) : max(a, b)].tolist()
    assert len(dac.File(dac.encode_file(np.zeros(0, np.uint32), []))) == 0


@pytest.mark.parametrize("file_ids", [50, 1 << 16])
def test_codes_of_documents(spark, file_ids):
    docs = odd_documents(spark, [(-5, "minus five", "en", "a"), (10**15, "far away", "en", "a")])
    files = dac.write_files(docs.repartition(5), public_vocabulary(), file_ids=file_ids)
    got = by(dac.read_documents(files), "start", "doc_id", "n_tokens", "ids_crc32")
    rows = sorted(docs.select("doc_id", "text").collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, (r.text or "").encode()))
    expected, start = [], 0
    for row, ids in zip(rows, library([r.text for r in rows])):
        expected.append((start, row.doc_id, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(got, key=lambda r: r[0]) == expected
    assert dac.read_documents(dac.write_files(no_documents(spark), public_vocabulary())).count() == 0


@pytest.mark.parametrize("size, open_windows, fan_in", [(16, 3, 2), (2048, 16, 32), (64, 1, 2)])
def test_packing_keeps_every_id_once(spark, size, open_windows, fan_in):
    more = [(100 + i, "one two three four five " * (i % 17), "en", "a") for i in range(200)]
    docs = odd_documents(spark, more).repartition(6)
    got = packing.pack_documents(docs, public_vocabulary(), size=size, open_windows=open_windows, fan_in=fan_in)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    pieces = [tuple(r) for r in got.collect()]
    rows = docs.select("doc_id", "text").collect()
    wanted = defaultdict(list)
    for row, ids in zip(rows, library([r.text for r in rows])):
        wanted[row.doc_id].append(ids)
    placed = defaultdict(list)
    for doc, start, length, crc, total, _, _ in pieces:
        assert length > 0 and any(
            len(ids) == total and zlib.crc32(ids[start : start + length].tobytes()) == crc for ids in wanted[doc]
        )
        placed[doc].append((start, length, total))
    for doc, found in placed.items():
        assert sum(n for _, n, _ in found) == sum(len(ids) for ids in wanted[doc])
    assert set(placed) == set(wanted)
    sequences = defaultdict(list)
    for _, _, length, _, _, sequence, offset in pieces:
        sequences[sequence].append((offset, length))
    short = 0
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= size
        short += end < size
    assert short <= 1


def test_packing_nothing(spark):
    assert packing.pack_documents(no_documents(spark), public_vocabulary()).count() == 0
