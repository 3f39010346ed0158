import functools
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from geotally.llm.packing import Encoder, Packer, pack
from tests.llm.helpers import ODD_TEXTS, clashing, docs

PATH = public_tokenizers.path("byte_bpe_50k.json")


@functools.cache
def tokenizer():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def ids_of(text):
    return [*tokenizer().encode(text or "", add_special_tokens=False).ids, 1]


def check(pieces, wanted, length):
    """Every id in one piece, sequences gapless, full or a power of two."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append((p.start, np.frombuffer(p.ids, "<u4").tolist(), p.length, p.doc_tokens))
        by_sequence[p.sequence_id].append((p.offset, p.length))
    assert set(by_doc) == set(wanted)
    for d, ids in wanted.items():
        joined = []
        for start, part, n, total in sorted(by_doc[d]):
            assert start == len(joined) and n == len(part) > 0 and total == len(ids)
            joined += part
        assert joined == ids
    for parts in by_sequence.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == length or (at < length and at & (at - 1) == 0)
    return len(by_sequence)


def test_every_id_lies_in_one_piece(spark):
    texts = [*ODD_TEXTS, "<|endoftext|> as text", *(f"document {k} " * (k % 90) for k in range(300))]
    got = pack(clashing(docs(spark, texts)).repartition(3), PATH, 256).collect()
    check(got, {k: ids_of(t) for k, t in enumerate(texts)}, 256)


def test_empty_table_and_null_texts(spark):
    assert pack(docs(spark, []), PATH).collect() == []
    (p,) = pack(docs(spark, [None]), PATH).collect()
    assert (p.start, p.length, p.doc_tokens, p.offset, p.ids) == (0, 1, 1, 0, b"\1\0\0\0")


def test_ids_of_the_fast_library_are_those_of_the_tokenizer():
    texts = [t or "" for t in ODD_TEXTS] + [
        "a  b", "a   b", "a\t b", "a \tb", "a\t\tb c", " lead", "  lead", "trail ", "trail  ", "\n\n x", "x \n y", "x\n y\n\n z", "it's we'll 've 's",
        "a\x1c b", "!\x1c? x", "a\u00a0 b c", "a \u00a0b", "\u3000 x y", "12 345,6 7.8 !!! ??", "<|endoftext|> a<|endoftext|>b", "a\x85 b", "\ufeff a b", "e\u0301 \u0301",
    ]
    rng = np.random.default_rng(0)
    texts += ["".join(rng.choice(list("abS' \n\t!1\u00a0\x1cé²ª\u0301\u3000日\U0001f600"), 30)) for _ in range(2000)]
    texts += ["x" * 3000, " " * 3000 + "a", "日本語 テスト", "ⅷ ① ² ʼn ǅ ª", "\x00\x01"]
    encoder = Encoder(PATH)
    for t in texts:
        assert [*encoder.ids(t), 1] == ids_of(t), repr(t)


@pytest.mark.parametrize("seed", range(4))
def test_best_level_has_the_least_sum_of_squares(seed):
    rng = np.random.default_rng(seed)
    packer = Packer(64)
    for _ in range(400):
        size = int(rng.integers(1, 64))
        chosen = packer.best_level(size)

        def after(level, size=size):
            n = packer.levels.copy()
            if level:
                n[level] -= 1
            if level + size < 64:
                n[level + size] += 1
            return int((n**2).sum())

        allowed = [0, *(h for h in range(1, 65 - size) if packer.levels[h])]
        assert chosen in allowed and after(chosen) == min(map(after, allowed))
        packer.add(0, np.zeros(size, "<u4"))
        assert packer.levels.sum() == packer.n_open


def test_open_sequences_are_bounded():
    packer = Packer(2048, most_open=16)
    rng = np.random.default_rng(0)
    total = 0
    for k in range(2000):
        n = int(rng.integers(1, 5000))
        packer.add(k, np.zeros(n, "<u4"))
        total += n
        assert packer.n_open <= 16
    packer.complete()
    sizes = [sum(len(p.ids) for p in held) for held in packer.done]
    assert sum(sizes) == total and all(s & (s - 1) == 0 for s in sizes)
