"""Token counts and packing against the tokenizer library; edits and fingerprints against plain Python."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from harborline.llm import fingerprints, packing, token_count
from tests.llm.rows import frame, make, sorted_rows

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def compiled():
    return token_count.TokenCounter(BYTES)


def odd_texts():
    rng = random.Random(3)
    pieces = ["'s", "'re", " ", "  ", "\n", "\t", "<|endoftext|>", "the", "ing", "é", "ß", "日本", "😀", "1", "2024", ".", "!!", " ", "a" * 90]
    made = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 30))) for _ in range(400)]
    return ["", "   ", "<|endoftext|>", " x <|endoftext|>  ", "q" * 5000, *made]


def test_transducer_counts_as_the_library(compiled):
    library = Tokenizer.from_file(BYTES)
    for text in odd_texts():
        assert compiled.count(text) == len(library.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("size", [1, 3, 16, 64])
def test_chunk_maps_compose_wherever_a_text_is_cut(compiled, size):
    for text in odd_texts()[:150]:
        if "<|endoftext|>" in text and size < 16:
            pass  # a special string cut by chunks is joined again by its neighbours
        maps = [compiled.chunk_map(text[i: i + size]) for i in range(0, len(text), size)] or [compiled.chunk_map("")]
        assert compiled.total(maps) == compiled.count(text)
        # any order of composition gives the same
        left = maps[0]
        for m in maps[1:]:
            left = compiled.compose(left, m)
        assert compiled.total([left]) == compiled.count(text)


def test_states_may_be_forgotten(monkeypatch, compiled):
    library = Tokenizer.from_file(BYTES)
    fresh = token_count.TokenCounter(BYTES)
    monkeypatch.setattr(token_count, "_MAX_STATES", 50)
    for text in odd_texts()[:40]:
        assert fresh.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_count_tokens(spark):
    library = Tokenizer.from_file(BYTES)
    rows = make()
    for chunk in (1 << 16, 37):
        got = token_count.count_tokens(frame(spark, rows), BYTES, chunk=chunk).collect()
        want = []
        for doc_id, text, *_ in rows:
            n = len(library.encode(text or "", add_special_tokens=False).ids)
            want.append((doc_id, len((text or "").encode()), n, n > 512))
        assert sorted_rows(got) == sorted_rows(want)
    assert token_count.count_tokens(frame(spark, []), BYTES).collect() == []


def test_packing_holds_every_id_once_and_pads_nothing(spark):
    library = Tokenizer.from_file(WORDS)
    rows = make()
    got = packing.pack(frame(spark, rows), WORDS, buffer=5000).collect()
    ids = {}
    for doc_id, text, *_ in rows:
        ids.setdefault((doc_id, text), [*library.encode(text or "", add_special_tokens=False).ids, 2])
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= 4096 and (at == 4096 or at & (at - 1) == 0) and at == pieces[0].sequence_tokens
    # every document's ids, as often as the document comes
    need = {}
    for doc_id, text, *_ in rows:
        need.setdefault((doc_id, len(ids[doc_id, text])), []).append(ids[doc_id, text])
    for (doc_id, total), versions in need.items():
        mine = [r for r in got if r.doc_id == doc_id and r.doc_tokens == total]
        assert sum(r.length for r in mine) == total * len(versions)
        for r in mine:
            assert any(zlib.crc32(np.array(v[r.start: r.start + r.length], "<u4").tobytes()) == r.ids_crc32 for v in versions)
    assert packing.pack(frame(spark, []), WORDS).collect() == []


def test_step_groups_hold_equal_tokens():
    packer = packing.Packer(buffer=10_000)
    rng = random.Random(1)
    rows = [r for i in range(500) for r in packer.add(i, bytes(4 * rng.randint(1, 3000)))] + list(packer.finish())
    groups, sizes = {}, {r[5]: r[8] for r in rows}
    for r in rows:
        if r[9] is not None:
            groups.setdefault((r[7], r[9]), set()).add(r[5])
    full = [sum(sizes[s] for s in members) for members in groups.values()]
    assert max(full) == packing.STEP_TOKENS and len({w for w, _ in groups}) > 1


def test_edits_follow_the_next_document(spark):
    rows = make()
    made = fingerprints.Fingerprinter()
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    want = []
    for (doc_id, text, *_), (_, following, *_) in zip(ordered, ordered[1:] + ordered[:1]):
        text, following = text or "", following or ""
        half = len(text) // 2
        changed = (text[: len(text) - half] if half else text) + following[:half]
        a, b, c = made(text), made(changed), made(following)
        want.append((
            doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), a.hex(), b.hex(),
            fingerprints.likeness(a, b), fingerprints.likeness(a, c),
        ))
    for parts in (1, 5, 40):
        assert sorted_rows(fingerprints.against_edits(frame(spark, rows), parts=parts).collect()) == sorted_rows(want)
    assert fingerprints.against_edits(frame(spark, [])).collect() == []
    one = fingerprints.against_edits(frame(spark, [(1, "abcd", "en", "s")])).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"abab").hexdigest() and one[0].near_next == 1.0


def plain_fingerprint(text, bits=128):
    """Every distinct shingle votes on every bit with 1 + ln of how often it occurs, by loops."""
    mask, mix = (1 << 64) - 1, fingerprints._MIX

    def mixed(x):
        x = (x ^ (x >> 29)) * mix[1] & mask
        return x ^ (x >> 32)

    words = [xxhash.xxh3_64_intdigest(w.encode()) for w in re.findall(r"[^\x20\x09-\x0D]+", text.lower())]
    n, terms = min(3, len(words)), {}
    for at in range(len(words) - n + 1 if words else 0):
        term = 0
        for w in words[at: at + n]:
            term = mixed((term * mix[0] + w) & mask)
        terms[term] = terms.get(term, 0) + 1
    out = 0
    for bit in range(bits):
        lane, at = divmod(bit, 64)
        votes = sum(round(64 * (1 + math.log(k))) * (1 if mixed(t ^ (mix[lane % 4] + lane & mask)) >> (63 - at) & 1 else -1) for t, k in terms.items())
        out = out << 1 | (votes > 0)
    return f"{out:032x}"


def test_fingerprints_are_weighted_votes():
    made = fingerprints.Fingerprinter()
    for text in [r[1] or "" for r in make() if len(r[1] or "") < 5000] + ["a b c " * 9 + "d e f g"]:
        assert made(text).hex() == plain_fingerprint(text)
    few = made("a b c d e")
    assert few == made("a b c d e") and few != made("a b c d e a b c a b c a b c")


def test_blocks_must_outnumber_the_radius(spark):
    prints = spark.createDataFrame([("0" * 32,)], "fingerprint string")
    for blocks in (2, 3, 33):
        with pytest.raises(ValueError):
            fingerprints.within(prints, radius=3, blocks=blocks)
    assert fingerprints.within(prints, radius=3, blocks=4).collect() == []


def test_every_pair_within_the_radius_is_found(spark):
    rng = random.Random(5)
    prints = [rng.getrandbits(128) for _ in range(60)]
    for p in prints[:30]:
        for flips in (1, 2, 3, 4):
            q = p
            for bit in rng.sample(range(128), flips):
                q ^= 1 << bit
            prints.append(q)
    texts = sorted({f"{p:032x}" for p in prints})
    got = {tuple(r) for r in fingerprints.within(spark.createDataFrame([(t,) for t in texts], "fingerprint string"), radius=3).collect()}
    want = {(a, b) for a in texts for b in texts if a < b and (int(a, 16) ^ int(b, 16)).bit_count() <= 3}
    assert got == want and want


def test_fingerprints_of_near_texts_are_near(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(500)]
    text = " ".join(rng.choice(words) for _ in range(400))
    other = " ".join(rng.choice(words) for _ in range(400))
    made = fingerprints.Fingerprinter()
    assert fingerprints.likeness(made(text), made(text + " tail")) > 0.9
    assert fingerprints.likeness(made(text), made(other)) < 0.4
    got = fingerprints.fingerprints(frame(spark, [(1, text, "en", "s")])).first()
    assert got.fingerprint == made(text).hex() and made("") == bytes(16)
    heavy = fingerprints.Fingerprinter(weight=lambda h: np.full(len(h), 2.0))
    assert heavy(text) == made(text)
    assert fingerprints.Fingerprinter(weight=lambda h: (h >> np.uint64(60)).astype(float))(text) != made(text)


def test_word_encoder_equals_the_tokenizer():
    whole, encode = Tokenizer.from_file(WORDS), packing.WordEncoder(WORDS)
    cases = [
        "", " \n", "Plain words, and marks... more!!! it's we'll DON'T 'S. 12, x2. a&b* %%%", "<|ENDOFTEXT|> a<|endoftext|>. <|endoftext|>, <| endoftext|>",
        "\u00c9\u0301. e\u0301, \u0130. I\u0307! x\u2003y. a\x1cb. \uff21B! \u0915\u093c. \u0958 gro\u00df* \u00aa. \u00b5, \u00a0? n\u00a0o.",
    ]
    cases += [r[1] or "" for r in make()]
    for _ in range(2):
        assert encode(cases) == [np.array(whole.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in cases]
