import random
import struct

import numpy as np
import pytest
import sentencepiece

from dialogprep.llm import pieces
from tests.llm.cases import documents, empty, texts

MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def field(number, value):
    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    if isinstance(value, bytes):
        return varint(number << 3 | 2) + varint(len(value)) + value
    return varint(number << 3 | 5) + struct.pack("<f", value) if isinstance(value, float) else varint(number << 3) + varint(value)


def unigram_model(scored, prefix=1):
    """A model file with the given pieces, for this package and for the sentencepiece library."""
    rows = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3), *[(f"<0x{b:02X}>", 0.0, 6) for b in range(256)], *[(p, s, 1) for p, s in scored]]
    out = b"".join(field(1, field(1, p.encode()) + field(2, float(s)) + field(3, t)) for p, s, t in rows)
    trainer = field(3, 1) + field(35, 1) + field(40, 0) + field(41, 1) + field(42, 2) + field(43, 2**64 - 1)
    return out + field(2, trainer) + field(3, field(1, b"identity") + field(3, prefix) + field(4, 0) + field(5, 1))


SCORED = [("▁the", -2.0), ("▁", -3.0), ("t", -6.1), ("h", -6.2), ("e", -5.3), ("he", -4.4), ("▁t", -4.5), ("a", -5.6), ("ab", -5.0), ("b", -6.7), ("▁▁", -4.8), ("é", -7.9), ("éa", -8.1), ("ba", -5.05)]


@pytest.mark.parametrize("prefix", [1, 0])
def test_equals_the_library_on_a_unigram_model(prefix):
    data = unigram_model(SCORED, prefix)
    library = sentencepiece.SentencePieceProcessor(model_proto=data)
    m = pieces.parse(data)
    encoder = pieces.Encoder(m)
    r = random.Random(4)
    for _ in range(400):
        text = "".join(r.choice("theab é  z\n€") for _ in range(r.randint(0, 24)))
        ids = encoder.encode([text])[0].tolist()
        want = library.encode(text)
        score = lambda tokens: sum(m.unknown / 1 if m.is_byte[i] else m.score[i] for i in tokens)
        assert ids == want or abs(score(ids) - score(want)) < 1e-4, text
        assert pieces.decode(m, np.array(ids, np.int32)) == text == (library.decode(want) if ids == want else text)


def test_best_path_equals_plain_search():
    m = pieces.parse(open(MODEL, "rb").read())
    table = {bytes(m.flat[m.first[i] : m.first[i + 1]]): i for i in range(len(m.first) - 1) if m.first[i + 1] > m.first[i] and not m.is_byte[i]}
    r = random.Random(1)
    for text in ["hello world", "Tokenization of naïve café", "  two  spaces ", "日本語 text 😀", *["".join(r.choice("abcde fgh") for _ in range(30)) for _ in range(20)]]:
        raw = b" " + text.encode()
        best = [0.0] + [-np.inf] * len(raw)
        for a in range(len(raw)):
            if best[a] == -np.inf:
                continue
            for b in range(a + 1, min(len(raw), a + 60) + 1):
                if (i := table.get(raw[a:b])) is not None:
                    best[b] = max(best[b], best[a] + m.score[i])
            width = next(k for k in range(1, 5) if a + k == len(raw) or raw[a + k] & 0xC0 != 0x80)
            if raw[a : a + width] not in table:
                best[a + width] = max(best[a + width], best[a] + m.unknown)
        ids = pieces.Encoder(m).encode([text])[0]
        unknown = len(set(raw.decode()) - {p.decode() for p in table if len(p) < 5})
        score = sum(m.score[i] for i in ids if not m.is_byte[i])
        if not unknown:
            assert score == pytest.approx(best[-1])
        assert pieces.decode(m, ids) == text


def test_trie_finds_every_piece():
    table = {b"a": 0, b"ab": 1, b"abc": 2, b"b": 3, bytes([255, 0]): 4, b"\0": 5}
    base, check, value = pieces._double_array(table)
    for piece, i in table.items():
        node = 0
        for c in piece:
            child = base[node] + c
            assert check[child] == node
            node = child
        assert value[node] == i


def test_forgetting_parts_changes_nothing(monkeypatch):
    m = pieces.parse(open(MODEL, "rb").read())
    some = [t for _, t, *_ in texts()]
    whole = [i.tolist() for i in pieces.Encoder(m).encode(some)]
    monkeypatch.setattr(pieces, "KEPT_PARTS", 0)
    encoder = pieces.Encoder(m)
    assert [encoder.encode([t])[0].tolist() for t in some] == whole


def test_round_trip_over_tables(spark):
    rows = texts() + [(60, "a▁b  ▁ c\x00\x7f\t", "en", "s"), (61, "x" * 3000, "en", "s"), (62, " ", "en", "s")]
    coded = pieces.encoded(documents(spark, rows, clash=["ids", "decoded"]), MODEL)
    got = pieces.byte_tokens(pieces.decoded(coded, MODEL), MODEL).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.decoded == (r.text or "")
        assert (r.ids == []) == (not r.text)
    assert pieces.encoded(empty(spark), MODEL).count() == 0
