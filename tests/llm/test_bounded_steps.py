"""Steps in bounded parts give what the whole would."""

from __future__ import annotations

import tracemalloc

import numpy as np
from tokenizers import Tokenizer

from tideledger.llm import packing, phrases
from tideledger.llm.queries import tokenizer_file


def test_mining_counts_and_memory():
    rng = np.random.default_rng(5)
    word = phrases._mixed(rng.integers(0, 300_000, 1_200_000).astype(np.uint64))
    piece = np.repeat(np.arange(120_000, dtype=np.int32), 10)
    tracemalloc.start()
    found = [(names.copy(), counts.copy()) for names, counts in phrases.mine(word, piece, 2, 2)]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    for size, (names, counts) in enumerate(found, 1):
        name = word if size == 1 else phrases._mixed(word[:-1] * np.uint64(0xD6E8FEB86659FD93) + word[1:])
        inside = name if size == 1 else name[piece[:-1] == piece[1:]]
        all_names, all_counts = np.unique(inside, return_counts=True)
        assert np.array_equal(names, all_names[all_counts >= 2]) and np.array_equal(counts, all_counts[all_counts >= 2])
    assert most < 4.5 * word.nbytes, most / word.nbytes


def test_pieces_in_slices(spark, monkeypatch):
    texts = ["plain words, 12 of them", "Ünïcödé ª µ º straße x2 don't we'll _a_b", None, "", "Слово и日本語 ひらがな 한국어", "<|end|> special", "naïve 漢字² ①", "a" * 300]
    rows = [(i if i % 3 else None, t) for i, t in enumerate(texts * 40)]
    monkeypatch.setattr(packing, "SLICE", 200)
    path = tokenizer_file()
    one = Tokenizer.from_file(path)
    made = packing.pieces(spark.createDataFrame(rows, "doc_id long, text string"), path, limit=64).collect()
    want = []
    for doc_id, text in rows:
        ids = np.array([*one.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        want += [(doc_id, k, at, len(ids[at:at + 64]), packing.zlib.crc32(ids[at:at + 64].tobytes())) for k, at in enumerate(range(0, len(ids), 64))]
    assert sorted(map(tuple, made), key=str) == sorted(want, key=str)
