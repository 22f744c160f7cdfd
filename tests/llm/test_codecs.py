"""Token segments, pieces, fingerprints and archives: round trips and plain versions."""

import hashlib
import io
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from conftest import ODD_ROWS
from tokenizers import Tokenizer

from civiltext.llm import pieces, piecewise, rans, token_store, warc

TEXTS = ["", " ", "a", " a b", "a b ", "a  b", "a \nb", "a\n b", "\n", "\n\n", "a\nb\n", "it's 12 o'clock",
         "x <|endoftext|> y", "é ü ñ 漢字  z", "a\tb\r\nc", "a\x85b \x1c c",
         "tail  ", "word " * 500, "▁ ▁a ▁▁", "\U0001f600 ok", "﻿a ​ b"]


def encoded(coder, texts):
    ids, sizes = coder.encode(pa.array(texts, pa.string()))
    return np.split(ids, np.cumsum(sizes)[:-1])


def packed(docs, **options):
    tokens = np.concatenate([np.zeros(0, np.uint32), *docs])
    return rans.encode_segment(tokens, [len(d) for d in docs], **options)


def test_words_encode_as_the_whole_text():
    plain = Tokenizer.from_file(public_tokenizers.path(token_store.VOCABULARY))
    got = encoded(token_store.WordTokenizer(token_store.VOCABULARY), TEXTS)
    for text, ids in zip(TEXTS, got):
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_documents_encode_as_the_whole_text(tables, monkeypatch):
    monkeypatch.setattr(token_store, "CACHE_BYTES", 150_000)
    texts = [r.text for r in tables("documents").collect()]
    plain = Tokenizer.from_file(public_tokenizers.path(token_store.VOCABULARY))
    coder = token_store.WordTokenizer(token_store.VOCABULARY)
    for at in range(0, len(texts), 20):
        for text, ids in zip(texts[at:at + 20], encoded(coder, texts[at:at + 20])):
            assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids


class Counting:
    """A tokenizer that counts the bytes it is given in batches."""

    def __init__(self, tokenizer):
        self.tokenizer, self.given = tokenizer, 0

    def encode_batch_fast(self, texts, **options):
        self.given += sum(map(len, texts))
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_many_words_are_kept_in_few_bytes(monkeypatch):
    """30,000 words, seen again and again, take the tokenizer no second time."""
    monkeypatch.setattr(token_store, "CACHE_BYTES", 4 << 20)
    coder = token_store.WordTokenizer(token_store.VOCABULARY)
    texts = [" ".join(f"w{(7919 * i) % 30_011}x" for i in range(at, at + 3000))
             for at in range(0, 30_000, 3000)]
    first = [encoded(coder, [text])[0].tolist() for text in texts]
    coder.tokenizer = Counting(coder.tokenizer)
    for _ in range(2):
        assert [encoded(coder, [text])[0].tolist() for text in texts] == first
    assert coder.tokenizer.given == 0
    plain = coder.tokenizer.tokenizer
    assert first == [plain.encode(text, add_special_tokens=False).ids for text in texts]


def test_words_with_equal_hashes(monkeypatch):
    hashes = token_store.text_hashes
    monkeypatch.setattr(token_store, "text_hashes", lambda words: hashes(words) >> np.uint64(58))
    monkeypatch.setattr(token_store, "CACHE_BYTES", 3000)
    plain = Tokenizer.from_file(public_tokenizers.path(token_store.VOCABULARY))
    coder = token_store.WordTokenizer(token_store.VOCABULARY)
    assert len(set(coder.later.new)) == 2
    for at in range(0, 600, 40):
        texts = [" ".join(f"ab{i * j % 97}" for j in range(9)) + "\n" for i in range(at, at + 60)]
        for text, ids in zip(texts, encoded(coder, texts)):
            assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids
    assert len(coder.later.new) <= 64


def test_small_batches_are_put_together():
    batches = [pa.record_batch({"text": pa.array(["x" * 100] * n, pa.string())})
               for n in (2, 1, 0, 5, 90, 2)]
    got = list(token_store.gathered(iter(batches), 700))
    assert [b.num_rows for b in got] == [3, 5, 90, 2] and got[2] is batches[4]
    assert list(token_store.gathered(iter([]), 800)) == []


def test_segments_round_trip():
    rng = np.random.default_rng(1)
    for sizes in ([], [0], [1], [0, 5, 0], [300_000], list(rng.integers(0, 3000, 200))):
        docs = [(rng.zipf(1.3, n) % 50_000).astype(np.uint32) for n in sizes]
        coded = packed(docs, block_tokens=50_000)
        back = rans.Segment.open(coded).documents()
        assert [d.tolist() for d in back] == [d.tolist() for d in docs]
    assert len(coded) < 4 * sum(sizes)


def test_decoding_from_a_checkpoint():
    index = np.random.default_rng(2).integers(0, 7, 200_000)
    freq = rans.frequency_table(np.bincount(index), 16)
    data = rans.encode_block(index, freq, 16)
    slots = np.repeat(np.arange(7), freq)
    at = rans.CHECKPOINT_STEPS * rans.LANES
    for number in (0, 1, 2):
        got = rans.decode_block(data, len(index), freq, slots, 16, number)
        assert (got == index[number * at:]).all()


def test_damage_is_noticed():
    coded = bytearray(packed([np.arange(1000, dtype=np.uint32)]))
    coded[-5] ^= 1
    with pytest.raises(ValueError):
        rans.Segment.open(bytes(coded)).documents()


def test_tables_with_many_rare_symbols():
    counts = np.array([10**9] + [1] * 60_000)
    freq = rans.frequency_table(counts, 16)
    assert freq.sum() == 1 << 16 and freq.min() == 1


def stored(spark, docs, tmp_path, **options):
    path = str(tmp_path / "tokens")
    token_store.write_tokens(docs, path, **options)
    return token_store.read_tokens(spark, path).orderBy("start").collect()


def test_stored_documents(spark, tables, tmp_path):
    docs = tables("documents").repartition(5)
    got = stored(spark, docs, tmp_path, segment_tokens=20_000)
    plain = Tokenizer.from_file(public_tokenizers.path(token_store.VOCABULARY))
    start = 0
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    assert len(got) == len(rows)
    for row, (id_, text) in zip(got, rows):
        ids = np.array(plain.encode(text, add_special_tokens=False).ids + [0], "<u4").tobytes()
        assert (row.id, row.start, row.n_tokens, row.ids_crc32, bytes(row.tokens)) \
            == (id_, start, len(ids) // 4, zlib.crc32(ids), ids)
        start += row.n_tokens


def test_stored_odd_rows(spark, odd, frame, tmp_path):
    got = stored(spark, odd, tmp_path)
    assert len(got) == len(ODD_ROWS) and [r.id for r in got[:2]] == [None, None]
    assert stored(spark, frame([]), tmp_path / "none") == []


def best_path(codec, text):
    """The best path by trying every piece at every place."""
    best = [(0.0, [])]
    for end in range(1, len(text) + 1):
        ways = [(best[start][0] + codec.pieces[text[start:end]][1], end - start, start)
                for start in range(max(0, end - 16), end) if text[start:end] in codec.pieces]
        score, _, start = max(ways)
        best.append((score, best[start][1] + [codec.pieces[text[start:end]][0]]))
    return best[-1][1]


def test_pieces_of_texts():
    codec = pieces.codec()
    for text in TEXTS:
        assert codec.decode(codec.encode(text)) == text
    rng = random.Random(4)
    for _ in range(300):
        text = "▁" + "".join(rng.choice(["the", "a", "in", "▁", "er", "x", "tion", "é"])
                             for _ in range(8))
        assert codec.best_path(text) == best_path(codec, text)
        spaced = text[1:].replace("▁", " ")
        if spaced:
            assert codec.encode(spaced).tolist() == best_path(codec, text)


def test_pieces_of_documents(tables, odd, frame):
    docs = tables("documents")
    got = pieces.round_trip(docs).collect()
    assert all(r.exact for r in got) and len(got) == docs.count()
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in pieces.decode(pieces.encode(docs)).collect():
        assert r.text == texts[r.id]
    back = pieces.decode(pieces.encode(odd))
    assert sorted(map(str, back.collect())) == sorted(
        map(str, odd.selectExpr("doc_id AS id", "coalesce(text, '') AS text").collect()))
    assert pieces.round_trip(frame([])).collect() == []
    assert pieces.encode(frame([])).collect() == []


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(before[j - 1] if x == y else 1 + min(before[j], row[-1]))
    return row[-1]


def test_likeness_is_an_edit_distance():
    rng = random.Random(6)
    for _ in range(200):
        a = "".join(rng.choice("abcd") for _ in range(rng.randrange(1, 70)))
        b = a[:20] + "".join(rng.choice("abcd") for _ in range(rng.randrange(1, 40)))
        got = piecewise.edit_likeness(a, b)
        expected = 1 - edit_distance(a, b) / (len(a) + len(b))
        assert got == pytest.approx(expected) or got == 0


def test_fingerprints_of_edited_texts():
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(4000)]
    for n in (200, 1000, 4000):
        text = " ".join(words[:n])
        changed = text[:len(text) // 2] + "#inserted#" + text[len(text) // 2:]
        other = " ".join(reversed(words[:n]))
        mark = piecewise.fingerprint(text)
        assert piecewise.likeness(mark, piecewise.fingerprint(changed)) > 0.9
        assert piecewise.likeness(mark, piecewise.fingerprint(other)) < 0.4
        assert piecewise.fingerprint("".join(text)) == mark


def test_neighbours(frame, tables):
    for rows in ([tuple(r) for r in tables("documents").select("doc_id", "text").collect()],
                 ODD_ROWS, [(1, "alone in the table")], []):
        got = piecewise.neighbour_likeness(frame(rows), buckets=7).collect()
        order = sorted(((i is not None, i, t or "") for i, t in rows),
                       key=lambda r: (r[0], r[1] or 0, r[2]))
        expected = []
        for at, (_, id_, text) in enumerate(order):
            following = order[(at + 1) % len(order)][2]
            n = len(text) // 4
            changed = text[:len(text) - n] + following[:n]
            mark, next_mark = piecewise.fingerprint(text), piecewise.fingerprint(following)
            new_mark = piecewise.fingerprint(changed)
            expected.append((id_, len(text), hashlib.sha256(changed.encode()).hexdigest(), mark,
                             new_mark, piecewise.likeness(mark, new_mark),
                             piecewise.likeness(mark, next_mark)))
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))


PAGES = [(3, "http://a/", "same"), (1, "http://b/", "same"), (2, None, "same"), (1, "u", "same"),
         (4, "http://c/", None), (5, "http://d/", ""), (None, "http://e/", "same"),
         (None, "http://f/", "only here"), (6, "x\r\ny: z", "WARC/1.0\r\n\r\nline\r\n\r\n" * 50),
         (7, "http://g/", "é" * 400_000)]


def archived(spark, rows, folder, **options):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string") \
                 .selectExpr("*", "1 AS id", "2 AS digest", "3 AS original").repartition(3)
    names = warc.write_monolithic(pages, f"{folder}/mono", **options)
    warc.normalise(spark, names, f"{folder}/mono", f"{folder}/members", remove_source=True)
    return warc.read_records(spark, names, f"file://{folder}/members").collect()


def test_archives(spark, tmp_path):
    got = archived(spark, PAGES, str(tmp_path))
    expected = []
    for id_, _, html in PAGES:
        payload = (html or "").encode()
        same = [i for i, _, h in PAGES if (h or "") == (html or "") and i is not None]
        first = min(same, default=None)
        kind = "response" if id_ == first else "revisit"
        expected.append((id_, len(payload), warc.payload_digest(payload), kind,
                         first if kind == "revisit" else None,
                         payload if kind == "response" else None))
    assert sorted(map(str, expected)) == sorted(
        str((*r[:5], None if r[5] is None else bytes(r[5]))) for r in got)
    assert archived(spark, [], str(tmp_path / "none")) == []


def test_small_payloads_are_responses(spark, tmp_path):
    got = archived(spark, PAGES, str(tmp_path), min_revisit=5)
    assert all(r.record_type == "response" for r in got)


def test_members_are_found_by_index(spark, tmp_path):
    archived(spark, PAGES, str(tmp_path))
    names = sorted(p.name for p in (tmp_path / "members").glob("*.gz"))
    assert names and not (tmp_path / "mono").exists()
    for name in names:
        data = (tmp_path / "members" / name).read_bytes()
        lines = (tmp_path / "members" / f"{name}.index").read_text().split("\n")[:-1]
        whole = b"".join(warc.read_member(io.BytesIO(data), *map(int, line.split()))
                         for line in reversed(lines))
        assert len(whole) == len(b"".join(warc.inflate(io.BytesIO(data))))


def test_normalising_again_finds_what_is_complete(spark, tmp_path):
    archived(spark, PAGES, str(tmp_path))
    names = sorted(p.name for p in (tmp_path / "members").glob("*.gz"))
    before = [(tmp_path / "members" / n).read_bytes() for n in names]
    (tmp_path / "mono").mkdir()
    warc.normalise(spark, names, f"{tmp_path}/mono", f"{tmp_path}/members", remove_source=True)
    assert [(tmp_path / "members" / n).read_bytes() for n in names] == before


HAN = ["".join(chr(0x4E00 + (i * 7 + j * j) % 20_000) for j in range(3000)) for i in range(40)]


def test_caches_are_bounded_by_bytes(monkeypatch):
    """Texts without blanks are one word each; none of them is kept."""
    monkeypatch.setattr(pieces, "CACHE_BYTES", 20_000)
    codec = pieces.PieceCodec(pieces.VOCABULARY)
    for text in [*HAN, " ".join(f"word{i}" for i in range(2000))]:
        assert codec.decode(codec.encode(text)) == text
    assert codec.held < 21_000 and max(map(len, codec.known)) <= pieces.CACHED_LENGTH
    assert sum(220 + 8 * len(w) for w in codec.known) == codec.held
    plain = Tokenizer.from_file(public_tokenizers.path(token_store.VOCABULARY))
    coder = token_store.WordTokenizer(token_store.VOCABULARY)
    for texts in (HAN[:20], [" ".join(HAN[20:])], HAN[:5], ["short"]):
        for text, ids in zip(texts, encoded(coder, texts)):
            assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids
    for known in (coder.first, coder.later):
        assert max(map(len, known.new)) <= token_store.CACHED_LENGTH and known.held < 10_000
