"""Tokenisers, packing, exact dedup, language, quality: fixtures with hard rows, and brute force."""

import base64
import hashlib
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import common, registry
from tidemark.llm.bpe import PrefixCode, PrefixVocabulary, bpe_encode
from tidemark.llm.language import codewords, identify_language
from tidemark.llm.packing import cut_documents, pack_documents, sequence_tokens, shortest_pack_first
from tidemark.llm.quality import score_quality
from tidemark.llm.recipes import chunk_ends, cut_places, dedup_exact, keep_distinct_texts

SF_DIR = "/root/testdata/sf0.01"
LONG = "lorem ipsum dolor " * 20_000
HARD = [
    (1, "The quick brown fox.", "en"),
    (2, None, None),
    (3, "", "en"),
    (4, " \t\n\x0b ", "de"),
    (5, LONG, "en"),
    (5, LONG, "en"),
    (6, "Σας ΣΑΣ İ 漢字\x1c\x85 <|endoftext|> it's 12345", "el"),
    (None, "The quick  brown fox.", "en"),
    (7, "Thequickbrownfox.", None),
]


def hard(spark, rows=None):
    """The rows with columns whose names the operators use themselves."""
    df = spark.createDataFrame(HARD if rows is None else rows, "doc_id long, text string, lang string")
    for name in ("id", "length", "ids", "n", "row_id", "_row", "node", "x", "label", "sequence_id", "keep_id", "kept"):
        df = df.withColumn(name, F.lit("own"))
    return df


@pytest.fixture(scope="module")
def ranks():
    with open(registry.BYTE_RANKS, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@pytest.fixture(scope="module")
def reference_encoding(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_of_documents_and_hard_rows(spark, reference_encoding):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    rows = docs.union(hard(spark).select("doc_id", "text"))
    found = bpe_encode(rows, registry.BYTE_RANKS, public_tokenizers.PATTERN).collect()
    texts = [row.text for row in rows.collect()]
    assert len(found) == len(texts)
    for row, text in zip(found, texts):
        ids = reference_encoding.encode_ordinary(text or "")
        assert bytes(row.ids).decode() == ",".join(map(str, ids))
        assert row.n_tokens == len(ids)
        assert bytes(row.decoded) == (text or "").encode()


def test_bpe_of_an_empty_table(spark):
    assert bpe_encode(hard(spark, []), registry.BYTE_RANKS, public_tokenizers.PATTERN).collect() == []


VOCABULARY = None


def vocabulary():
    global VOCABULARY
    VOCABULARY = VOCABULARY or PrefixVocabulary.from_file(registry.BYTE_RANKS)
    return VOCABULARY


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=80), st.integers(0, 80), st.integers(0, 8), st.binary(max_size=8), st.binary(max_size=20))
def test_appends_and_edits_equal_encoding_anew(data, start, width, new, more):
    start = min(start, len(data))
    stop = min(len(data), start + width)
    code = PrefixCode(vocabulary(), data)
    code.replace(start, stop, new)
    code.append(more)
    assert code.ids() == PrefixCode(vocabulary(), data[:start] + new + data[stop:] + more).ids()


def test_an_edit_is_local():
    code = PrefixCode(vocabulary(), b"some words of a long line " * 400)
    assert code.replace(20, 24, b"text") < 400


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abcdehint o", max_size=60))
def test_bpe_equals_naive_merging(text):
    piece = text.encode()
    parts = [piece[k : k + 1] for k in range(len(piece))]
    ranks = vocabulary().whole
    while True:
        merges = [(ranks.get(a + b, 1 << 30), k) for k, (a, b) in enumerate(zip(parts, parts[1:]))]
        if not merges or min(merges)[0] == 1 << 30:
            break
        k = min(merges)[1]
        parts[k : k + 2] = [parts[k] + parts[k + 1]]
    assert PrefixCode(vocabulary(), piece).ids() == [ranks[p] for p in parts]


def test_packing_of_documents_and_hard_rows(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    rows = docs.union(hard(spark).select("doc_id", "text"))
    placed = pack_documents(rows, registry.WORD_TOKENIZER, end_id=2, size=4096).cache()
    tokenizer = Tokenizer.from_file(registry.WORD_TOKENIZER)
    tokenizer.encode_special_tokens = True
    expected = sorted(
        [row.doc_id is None, row.doc_id or 0, tokenizer.encode(row.text or "", add_special_tokens=False).ids + [2]]
        for row in rows.collect()
    )
    pieces = placed.collect()
    by_doc = {}
    for piece in pieces:
        ids = np.frombuffer(piece.ids, "<u4")
        assert piece.length == len(ids) and piece.ids_crc32 == zlib.crc32(piece.ids)
        by_doc.setdefault((piece.doc_id is None, piece.doc_id or 0, piece.doc_tokens), []).append((piece.start, ids.tolist()))
    found = []
    for (missing, doc_id, tokens), parts in by_doc.items():
        copies = sum(start == 0 for start, _ in parts)
        joined = sum((ids for _, ids in sorted(parts)[::copies]), [])
        assert len(joined) == tokens
        found += [[missing, doc_id, joined]] * copies
    assert sorted(found) == expected
    filled = {}
    for piece in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert piece.offset == filled.get(piece.sequence_id, 0)
        filled[piece.sequence_id] = piece.offset + piece.length
    assert max(filled.values()) <= 4096
    assert sum(filled.values()) > 0.95 * 4096 * len(filled)
    whole = {row.sequence_id: len(row.ids) // 4 for row in sequence_tokens(placed).collect()}
    assert whole == filled


def test_packing_has_the_ids_of_the_tokenizer_at_its_defaults(spark, tmp_path):
    texts = ["a <|endoftext|> b", "word<|startoftext|>e\u0301<|endoftext|><|endoftext|>\u0301s", "<|ENDOFTEXT|> <|endoftext| >", "it's 漢<|endoftext|>字", None]
    docs = hard(spark, [(k, text, "en") for k, text in enumerate(texts)])
    docs.select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    tokenizer = Tokenizer.from_file(registry.WORD_TOKENIZER)
    expected = [np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4").tobytes() for text in texts]
    for found in (registry.op3_packing(spark, str(tmp_path)), corpus_pipeline.packing(spark, docs, "")):
        rows = {row.doc_id: row for row in found.collect()}
        assert [rows[k].ids_crc32 for k in range(len(texts))] == [zlib.crc32(ids) for ids in expected]
        assert [rows[k].doc_tokens for k in range(len(texts))] == [len(ids) // 4 for ids in expected]


def test_packing_of_an_empty_table(spark):
    assert pack_documents(hard(spark, []), registry.WORD_TOKENIZER).collect() == []


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 50), max_size=12))
def test_places_hold_each_piece_once_and_fill_without_gaps(histogram):
    filled, ranks = {}, {}
    for length, rank, count, first, offset in shortest_pack_first(histogram, 32):
        assert rank == ranks.get(length, 0)
        ranks[length] = rank + count
        for sequence in range(first, first + count):
            assert filled.get(sequence, 0) == offset
            filled[sequence] = offset + length
    assert ranks == histogram
    assert all(size <= 32 for size in filled.values())


def test_exact_dedup_keeps_the_longest_text(spark):
    rows = hard(spark).collect()
    texts = [row.text or "" for row in rows]
    bare = ["".join(c for c in text if c not in " \t\n\x0b\x0c\r") for text in texts]
    found = dedup_exact(hard(spark)).collect()
    assert sorted(row.text_sha256 for row in found) == sorted(hashlib.sha256(b.encode()).hexdigest() for b in bare)
    for row in found:
        group = [k for k, b in enumerate(bare) if hashlib.sha256(b.encode()).hexdigest() == row.text_sha256]
        best = min(group, key=lambda k: (-len(texts[k]), rows[k].doc_id is None, rows[k].doc_id or 0, k))
        assert (row.keep_id, row.group_size) == (rows[best].doc_id, len(group))
    assert sum(row.kept for row in found) == len(set(bare))
    kept = keep_distinct_texts(hard(spark))
    assert kept.count() == len(set(bare)) and kept.columns == hard(spark).columns
    assert all(row._row == row.row_id == "own" for row in kept.collect())
    assert dedup_exact(hard(spark, [])).collect() == []


@settings(max_examples=50, deadline=None)
@given(st.binary(max_size=3_000), st.binary(max_size=3_000))
def test_cuts_do_not_depend_on_what_stands_before(before, text):
    text = text * 12
    alone = chunk_ends(cut_places(text), 0, len(text))
    after = chunk_ends(cut_places(before + text), len(before), len(before) + len(text))
    assert [end - len(before) for end in after] == alone


def test_copies_share_chunks_beyond_an_insertion():
    data = np.random.default_rng(3).integers(97, 123, 40_000, np.uint8).tobytes()
    other = data[:500] + b"inserted" + data[500:]
    chunks = [
        {t[a:b] for a, b in zip([0, *ends], ends)}
        for t, ends in ((t, chunk_ends(cut_places(t), 0, len(t))) for t in (data, other))
    ]
    assert len(chunks[0] & chunks[1]) >= len(chunks[0]) - 2


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_agrees_with_sql(spark, name):
    found = registry.queries()[name](spark, SF_DIR)
    database = duckdb.connect()
    for table in ("documents", "pages"):
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')")
    cursor = database.execute(registry.oracle_sql()[name])
    names = [column[0] for column in cursor.description]
    assert sorted(found.columns) == sorted(names)
    assert sorted(map(repr, map(tuple, found.select(*names).collect()))) == sorted(map(repr, cursor.fetchall()))


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = {row.doc_id: row for row in registry.op8_language_codes(spark, SF_DIR).collect()}
    held = [row for row in docs.collect() if zlib.crc32(str(row.doc_id).encode()) % 3 == 1]
    assert len(found) == docs.count()
    assert all(found[row.doc_id].held_out for row in held)
    assert sum(found[row.doc_id].lang_pred == row.lang for row in held) >= 0.99 * len(held)


def test_language_of_hard_rows(spark):
    found = {row.doc_id: row for row in identify_language(hard(spark)).collect()}
    assert {found[k].lang_pred for k in (2, 3, 4)} == {"und"}
    assert all(0 <= row.score <= 1 for row in found.values())
    assert found[None].held_out is None and found[None].lang_pred != "und"
    assert identify_language(hard(spark)).count() == len(HARD)
    assert identify_language(hard(spark, [])).collect() == []
    untaught = identify_language(hard(spark).withColumn("lang", F.lit(None).cast("string")))
    assert {(row.lang_pred, row.score) for row in untaught.collect()} == {("und", 0.0)}


@pytest.mark.parametrize("languages", [1, 2, 3, 7, 8, 40])
def test_codewords_differ(languages):
    words = codewords(languages)
    assert len({tuple(word) for word in words}) == languages
    if languages > 7:
        assert ((words.shape[1] - words @ words.T) / 2 + 1e6 * np.eye(languages)).min() >= words.shape[1] / 5


def test_quality_of_held_out_documents(spark):
    labels = {row.doc_id: row.quality for row in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    found = registry.op10_quality_discriminant(spark, SF_DIR).collect()
    held = [row for row in found if zlib.crc32(str(row.doc_id).encode()) % 5 == 0]
    assert all(row.held_out for row in held) and sum(row.held_out for row in found) == len(held)
    judged = [row for row in held if row.doc_id in labels]
    assert sum(row.predicted == labels[row.doc_id] for row in judged) >= 0.97 * len(judged)
    assert all(0 <= row.score <= 1 and row.predicted == (row.score >= 0.3) for row in found)


def test_quality_of_hard_rows_and_labels(spark):
    marks = [(1, 1), (1, 0), (4, 0), (5, 1), (6, None), (None, 1), (7, 0), (7, 0), (99, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int").withColumn("text", F.lit("own"))
    found = score_quality(hard(spark), labels).collect()
    assert len(found) == len(HARD) and all(0 <= row.score <= 1 for row in found)
    assert score_quality(hard(spark, []), labels).collect() == []
    assert {row.score for row in score_quality(hard(spark), labels.limit(0)).collect()} == {0.5}


def test_tables_are_written_in_short_batches_and_the_setting_comes_back(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    before = spark.conf.get(common.BATCH_SETTING)
    counted = spark.range(0, 2_500, 1, 1).mapInArrow(sizes, "n long")
    assert [row.n for row in common.written(counted, "sizes").collect()] == [1_024, 1_024, 452]
    assert spark.conf.get(common.BATCH_SETTING) == before
    assert [row.n for row in counted.collect()] == [2_500]


def test_a_process_remembers_for_one_operator_at_a_time():
    words = common.remembered("a", dict)
    words["x"] = 1
    assert common.remembered("a", dict) is words
    common.remembered("b", dict)
    assert common.remembered("a", dict) == {}
    common.forget()


def test_without_ids_a_piece_has_the_checksum_of_its_ids_and_no_ids_leave_the_task(spark):
    docs = hard(spark)
    names = ["doc_id", "start", "length", "doc_tokens", "ids_crc32"]
    whole = cut_documents(docs, registry.WORD_TOKENIZER, 2, 16)
    short = cut_documents(docs, registry.WORD_TOKENIZER, 2, 16, keep_ids=False)
    assert short.columns == ["doc_id", "start", "length", "doc_tokens", "ids_crc32"]
    rows = whole.collect()
    assert sorted(map(repr, short.select(*names).collect())) == sorted(map(repr, whole.select(*names).collect()))
    assert all(row.ids_crc32 == zlib.crc32(row.ids) for row in rows)
