"""Tokens, packing, languages, SimHash and repeated strings against plain versions of themselves."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from promptmill.llm import repeats, run_index
from promptmill.llm.components import connected_components
from promptmill.llm.language_id import LanguageModel, fit_languages, label_languages, viterbi
from promptmill.llm.packing import Capacity, best_fit, pack_best_fit
from promptmill.llm.queries import QUERIES
from promptmill.llm.simhash import fingerprint, linked_stars, simhash_groups
from promptmill.llm.token_counts import answer, context_limits, length_histogram
from promptmill.llm.tokenizing import TextEncoder, _cuts, token_pieces

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def reference():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_ids_equal_those_of_tokenizers(reference):
    draw, encoder = random.Random(1), TextEncoder()
    parts = ["a", "the", " ", "  ", "\n", "\t", "é", "don't", "'s", "12", "日本", "😀", "...", "\r\n", "b", "<|endoftext|>", "<|endof"]
    for _ in range(500):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 25)))
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == reference(text)


def test_special_tokens_have_their_own_ids(reference):
    end = "<|endoftext|>"
    for text in (end, f"{end} a", f"a {end}", f"hello {end} world", f"a{end}{end}\n{end}b", f"<{end}>"):
        assert np.frombuffer(TextEncoder().encode(text), "<u4").tolist() == reference(text)
    assert np.frombuffer(TextEncoder().encode(f"hello {end} world"), "<u4").tolist() == [31373, 220, 50256, 995]


@pytest.mark.parametrize("text", ["some words  and\n more of them, " * 20, "one <|endoftext|> two three, " * 20])
def test_long_texts_are_cut_without_effect(monkeypatch, reference, text):
    monkeypatch.setattr("promptmill.llm.tokenizing.LONG", 20)
    assert len(list(_cuts(text))) > 5 and "".join(_cuts(text)) == text
    assert np.frombuffer(TextEncoder().encode(text), "<u4").tolist() == reference(text)


def test_pieces_and_packing(tricky, reference):
    pieces = token_pieces(tricky, length=64)
    packed = pack_best_fit(pieces, Capacity(tokens=64), group_rows=50).collect()
    whole, expected = defaultdict(list), Counter()
    for row in sorted(packed, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["piece"])):
        assert len(row["ids"]) == 4 * row["length"] <= 256
        if row["piece"]:
            assert row["length"] == 64
        whole[row["doc_id"]].append((row["start"], np.frombuffer(row["ids"], "<u4").tolist()))
    for doc_id, text in tricky.select("doc_id", "text").collect():
        expected[doc_id] += len(reference(text)) + 1
        if doc_id in (0, 3, 4, 7, 10):
            assert sum((ids for _, ids in sorted(whole[doc_id])), []) == [*reference(text), 2]
    assert {k: sum(len(ids) for _, ids in v) for k, v in whole.items()} == expected
    check_sequences(packed, 64)
    total = sum(r["length"] for r in packed)
    assert len({r["sequence_id"] for r in packed}) <= total / 64 * 1.1 + 2


def check_sequences(rows, tokens):
    held = defaultdict(list)
    for row in rows:
        held[row["sequence_id"]].append((row["offset"], row["length"]))
    for places in held.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= tokens


def test_packing_query(spark, reference):
    rows = QUERIES["op3_best_fit_packing"](spark, SF).collect()
    check_sequences(rows, 1024)
    want = []
    for doc_id, text in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        ids = [*reference(text), 2]
        first = (len(ids) - 1) % 1024 + 1
        bounds = [0, *range(first, len(ids) + 1, 1024)]
        for piece, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
            want.append((doc_id, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == sorted(want)
    assert len({r["sequence_id"] for r in rows}) <= sum(r["length"] for r in rows) / 1024 + 2


@pytest.mark.parametrize("score", ["norm", "dot"])
def test_best_fit_keeps_every_constraint(score):
    draw = np.random.default_rng(4)
    lengths = draw.integers(1, 60, 300)
    capacity = Capacity(tokens=60, documents=3, attention=2_500 + 1_100, score=score)
    bins, offsets = best_fit(lengths, capacity)
    for b in range(bins.max() + 1):
        inside = lengths[bins == b]
        assert inside.sum() <= 60 and len(inside) <= 3 and (inside**2).sum() <= 3_600
        order = np.argsort(offsets[bins == b])
        assert (offsets[bins == b][order] == np.cumsum(inside[order]) - inside[order]).all()
    with pytest.raises(ValueError):
        best_fit(np.array([61]), capacity)


def test_empty_tables(spark, empty):
    assert pack_best_fit(token_pieces(empty)).count() == 0
    assert context_limits(length_histogram(empty)).count() == 0
    assert simhash_groups(empty).count() == 0
    assert repeats.remove_repeats(empty).count() == 0
    assert label_languages(empty, fit_languages(empty, F.lit(True))).count() == 0


def test_token_counts(tricky, reference):
    lengths = sorted(len(reference(r["text"])) for r in tricky.collect())
    limits = context_limits(length_histogram(tricky), chunk=16)
    rows = {r["context_limit"]: r for r in limits.collect()}
    assert sorted(rows) == sorted(set(lengths))
    for limit, row in rows.items():
        within = [x for x in lengths if x <= limit]
        assert (row["docs_within"], row["tokens_within"]) == (len(within), sum(within))
        assert row["tokens_truncated"] == sum(min(x, limit) for x in lengths)
        assert row["tokens_lost"] == sum(max(x - limit, 0) for x in lengths)
        assert row["quantile"] == len(within) / len(lengths)
    for row in answer(limits, [1, 77, 10**6]).collect():
        assert row["tokens_truncated"] == sum(min(x, row["context_limit"]) for x in lengths)
        assert row["docs_over"] == sum(x > row["context_limit"] for x in lengths)


def test_viterbi_equals_plain_dynamic_programming():
    draw = np.random.default_rng(3)
    for _ in range(200):
        emitted = draw.normal(0, draw.choice([0.3, 2.0]), (draw.integers(1, 9), 3))
        score = lambda path, e=emitted: sum(e[i, k] for i, k in enumerate(path)) - 2.5 * sum(a != b for a, b in zip(path, path[1:], strict=False))
        paths = [()]
        for _ in range(len(emitted)):
            paths = [(*p, k) for p in paths for k in range(3)]
        assert score(viterbi(emitted, 2.5).tolist()) == pytest.approx(max(map(score, paths)))


def test_viterbi_changes_between_two_languages_that_are_not_the_best_single_one():
    emitted = np.array([[0, -2.5, -6]] * 4 + [[-6, -2.5, 0]] * 4)
    assert viterbi(emitted, 12.0).tolist() == [0] * 4 + [2] * 4


def test_language_accuracy_and_spans(spark):
    rows = QUERIES["op5_language_id"](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    held = rows.join(docs, "doc_id").filter("held_out").select((F.col("lang") == F.col("lang_pred")).cast("int").alias("ok"), "score")
    assert held.agg(F.avg("ok")).first()[0] > 0.95
    assert held.filter("score < 0 OR score > 1").count() == 0


def test_mixed_texts_have_spans(spark):
    one, two = "the thing with this and that", "der ich nicht und über schön"
    train = spark.createDataFrame([(i, t, k) for i in range(40) for t, k in ((one, "en"), (two, "de"))], "doc_id long, text string, lang string")
    model = fit_languages(train, F.lit(True))
    model.penalty = 3.0
    lang, score, spans = model.label(f"{one} 12 {two} {two}!")
    assert lang == "de" and 0.5 < score < 1 and [s[2] for s in spans] == ["en", "de"]
    assert spans[0][:2] == (0, len(one)) and spans[1][1] == len(f"{one} 12 {two} {two}")
    assert model.label("12 !") == model.label(None) == ("und", 0.0, [])
    cyrillic = LanguageModel(["en", "ru"], model.scores, np.zeros_like(model.scripts))
    cyrillic.scripts[:, 1] = True
    assert cyrillic.label(one)[0] == "ru"  # the script leaves one language


def test_languages_of_tricky_rows(tricky):
    rows = label_languages(tricky, fit_languages(tricky, F.lit(True))).collect()
    assert len(rows) == tricky.count() and set(tricky.columns) < set(rows[0].asDict())
    for row in rows:
        lettered = any(c.isalpha() for c in row["text"] or "")
        assert (row["_language"]["lang"] == "und") == (not lettered)


def slow_fingerprint(text):
    table = {i: i + 32 for i in range(65, 91)}
    tokens = [w for w in "".join(c if c not in " \t\n\v\f\r" else " " for c in (text or "").translate(table)).split(" ") if w]
    if not tokens:
        return 0
    shingles = [" ".join(tokens[i : i + 4]) for i in range(max(len(tokens) - 3, 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", " \n", "One", "A b C", "É a b c\td e\x1cf g", "x y z w " * 9])
def test_fingerprint(text):
    assert fingerprint(text) == slow_fingerprint(text)


def slow_components(ids, fits):
    low = {i: i for i in ids}
    moved = True
    while moved:
        moved = False
        for a in ids:
            for b in ids:
                if fits(a, b) and low[a] > low[b]:
                    low[a], moved = low[b], True
    return low


def test_simhash_groups(spark, tricky):
    found = {r["doc_id"]: r for r in simhash_groups(tricky).collect()}
    texts = {r["doc_id"]: slow_fingerprint(r["text"]) for r in tricky.collect() if r["doc_id"] is not None}
    low = slow_components(list(texts), lambda a, b: (texts[a] ^ texts[b]).bit_count() <= 4)
    assert {k: v["component_id"] for k, v in found.items() if k is not None} == low
    assert found[None]["component_id"] is None
    assert {k: v["bits"] % (1 << 64) for k, v in found.items() if k is not None} == texts


def test_tiles_find_all_links():
    draw = random.Random(5)
    values = [draw.getrandbits(64) for _ in range(60)]
    values += [v ^ (1 << draw.randrange(64)) ^ (1 << draw.randrange(64)) for v in values[:30]]
    array = np.array(values, dtype=np.uint64)
    near = lambda a, b: (values[a] ^ values[b]).bit_count() <= 4
    member, root = linked_stars(array, None, 4)
    low = slow_components(range(len(values)), near)
    got = slow_components(range(len(values)), lambda a, b, e=set(zip(member, root, strict=True)): (a, b) in e or (b, a) in e)
    assert got == low
    member, root = linked_stars(array[:60], array[60:], 4)
    across = lambda a, b: near(a, b) and (a < 60) != (b < 60)
    edges = set(zip(member.tolist(), root.tolist(), strict=True))
    assert slow_components(range(90), lambda a, b: (a, b) in edges or (b, a) in edges) == slow_components(range(90), across)


def test_components(spark):
    draw = random.Random(6)
    edges = [(draw.randrange(120), draw.randrange(120)) for _ in range(70)] + [(i, i + 1) for i in range(200, 240)]
    table = spark.createDataFrame([*edges, (None, 3), (4, 4)], "a long, b long")
    got = {r["node"]: r["component"] for r in connected_components(table).collect()}
    real = [(a, b) for a, b in edges if a != b]
    nodes = sorted({x for e in real for x in e})
    every = set(real) | {(b, a) for a, b in real}
    assert got == slow_components(nodes, lambda a, b: (a, b) in every)


def flags(segments, length):
    count = Counter(s[i : i + length] for s in segments for i in range(len(s) - length + 1))
    return [[count[s[i : i + length]] > 1 for i in range(len(s) - length + 1)] for s in segments]


def test_run_index_matching_statistics():
    draw = random.Random(2)
    letters = b"ab\x00"
    for _ in range(150):
        base = bytes(draw.choice(letters) for _ in range(40))
        length = draw.randint(1, 9)
        segments = [
            bytes(draw.choice(letters) for _ in range(draw.randint(length, 25))) if draw.random() < 0.5 else base[draw.randint(0, 10) : draw.randint(20, 40)]
            for _ in range(draw.randint(1, 8))
        ]
        index, begins = run_index.build(segments)
        assert len(index.begin) <= index.size
        long = index.matching_statistics() >= length
        assert [long[b : b + len(s) - length + 1].tolist() for b, s in zip(begins.tolist(), segments, strict=True)] == flags(segments, length)


def slow_repeats(texts, length):
    data = [(t or "").encode() for t in texts]
    out = []
    for one, marks in zip(data, flags(data, length), strict=True):
        covered = np.zeros(len(one), dtype=bool)
        for i, repeated in enumerate(marks):
            if repeated:
                covered[i : i + length] = True
        out.append((bytes(np.frombuffer(one, np.uint8)[~covered]), len(one)))
    return out


@pytest.mark.parametrize("most", [256, 1])
def test_repeats(tricky, monkeypatch, most):
    """With ``most`` 1 every anchor goes the way of those with very many segments."""
    monkeypatch.setattr(repeats, "MOST_SEGMENTS", most)
    rows = tricky.collect()
    want = Counter((r["doc_id"], *x) for r, x in zip(rows, slow_repeats([r["text"] for r in rows], 200), strict=True))
    found = repeats.remove_repeats(tricky).collect()
    got = Counter((r["doc_id"], bytes(r["_repeats"]["kept"]), r["_repeats"]["n_bytes"]) for r in found)
    assert got == want and set(tricky.columns) < set(found[0].asDict())


def test_hot_anchors_and_segments_go_to_several_tasks(tricky, monkeypatch):
    for name, value in (("HOT", 2), ("MOST_HOT", 1 << 40), ("SALTS", 3)):
        monkeypatch.setattr(repeats, name, value)
    test_repeats(tricky, monkeypatch, 4)


def test_spans_of_a_text_are_merged_before_they_are_gathered(spark):
    spans = [(1, 7, 0, 5), (1, 7, 5, 9), (1, 7, 2, 3), (1, 7, 11, 12), (2, 7, 4, 8), (2, 7, 4, 8)]
    table = spark.createDataFrame(spans, "k long, c long, start long, end long")
    found = {r["k"]: sorted(map(tuple, r["spans"])) for r in repeats._joined(table).collect()}
    assert found == {1: [(0, 9), (11, 12)], 2: [(4, 8)]}


def test_equal_windows_meet_in_one_core():
    draw = random.Random(9)
    shared = bytes(draw.choice(b"abcd") for _ in range(90))
    for length in (8, 40, 60):
        met = {}
        for _ in range(12):
            a, b = draw.randint(0, 30), draw.randint(50, 90)
            sides = [bytes(draw.choice(b"abcd") for _ in range(draw.randint(0, 40))) for _ in range(2)]
            data = sides[0] + shared[a:b] + sides[1]
            found = repeats.segments_of(data, length)
            for anchor, begin, count in zip(found.anchor.tolist(), found.begin.tolist(), found.windows.tolist(), strict=True):
                segment = data[begin : begin + count + length - 1]
                pieces = repeats._pieces(segment, anchor, length, min(repeats.STRIDE, length))
                assert pieces["n"].sum() == count
                for piece in pieces.itertuples():
                    for i in range(piece.s, piece.s + piece.n):
                        met.setdefault(segment[i : i + length], set()).add((anchor, piece.b, piece.core, piece.h[i - piece.s]))
        assert {len(places) for places in met.values()} == {1}


def test_repeats_query(spark):
    texts = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = {r["doc_id"]: hashlib.sha256(x[0]).hexdigest() for r, x in zip(texts, slow_repeats([r["text"] for r in texts], 200), strict=True)}
    got = {r["doc_id"]: r["kept_sha256"] for r in QUERIES["op7_suffix_array_dedup"](spark, SF).collect()}
    assert got == want


def test_spans_keep_characters_whole():
    data = "aéb".encode()
    assert repeats.whole_characters(data, [(2, 4)]) == [(3, 4)]
    assert repeats.whole_characters(data, [(0, 2)]) == [(0, 1)]
    assert repeats.whole_characters(data, [(2, 3)]) == []


def test_simhash_query(spark):
    docs = {r["doc_id"]: fingerprint(r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    root = slow_components(sorted(docs), lambda a, b: (docs[a] ^ docs[b]).bit_count() <= 4)
    rows = QUERIES["op9_simhash_near_dedup"](spark, SF).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == {i: (f"{x:016x}", root[i]) for i, x in docs.items()}
    assert len(rows) == len(docs)


def test_token_count_query(spark, reference):
    lengths = [len(reference(r["text"])) for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    rows = {r["context_limit"]: r for r in QUERIES["op10_token_counts"](spark, SF).collect()}
    assert sorted(rows) == sorted(set(lengths))
    for limit, row in rows.items():
        assert row["tokens_truncated"] == sum(min(n, limit) for n in lengths)
        assert row["docs_within"] == sum(n <= limit for n in lengths)
