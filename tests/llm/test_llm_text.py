import hashlib
import random

import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowlake.llm import chat, hashing, sentencepiece_bpe
from flowlake.llm.queries_text import TRICKY, op3_chat_formatting, op6_sentencepiece, piece_model
from flowlake.llm.sentencepiece_bpe import MergeVocabulary, encode_decode

TURNS = "conv_id long, turn long, role string, text string, turns string, formatted int"


def spoken(rows):
    return [(r["role"], r["text"]) for r in rows]


def formatted(spark, rows):
    df = spark.createDataFrame([(*r, "extra", 1) for r in rows], TURNS)
    return chat.format_conversations(df)


@pytest.fixture(scope="module")
def cases():
    rng = random.Random(1)
    marks = ["</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|part|>", "<|end|>", "<|role|>", "<|text|>", "<", "[", "\\", " ", "é", "\n"]
    rows = []
    for conv in range(40):
        for turn in range(rng.randrange(1, 7)):
            role = rng.choice(["user", "assistant", "system", "tool", "<|end|>"])
            rows.append((conv, turn, role, "".join(rng.choice(marks) for _ in range(rng.randrange(12)))))
    return rows


def test_every_turn_is_read_back(spark, cases):
    out = formatted(spark, cases)
    back = {r.conv_id: r for r in chat.read_back(out).collect()}
    for conv in range(40):
        own = sorted(r[1:] for r in cases if r[0] == conv)
        assert spoken(back[conv].turns) == [(role, text) for _, role, text in own]
        assert back[conv].learned == "".join(text for _, role, text in own if role == "assistant")
    for row in out.collect():
        assert sum(s["chars"] for s in row.segments) == len(row.formatted)


def test_neighbours_of_one_role_share_a_run(spark):
    rows = [(1, 3, "user", "c"), (1, 1, "user", "a"), (1, 2, "user", "b"), (1, 4, "assistant", "d")]
    row = formatted(spark, rows).first()
    assert row.formatted == "[INST] a<|part|>b<|part|>c [/INST]<s> d </s>"


def test_nulls_ties_repeats_and_long_texts(spark):
    rows = [(None, None, None, None), (None, 1, "user", "x"), (2, 1, "user", "b"), (2, 1, "user", "a"), (2, 1, "user", "a"), (3, 0, "assistant", "w " * 50_000)]
    back = {r.conv_id: r for r in chat.read_back(formatted(spark, rows)).collect()}
    assert spoken(back[None].turns) == [("", ""), ("user", "x")]
    assert spoken(back[2].turns) == [("user", "a"), ("user", "a"), ("user", "b")]
    assert len(back[3].learned) == 100_000
    assert formatted(spark, []).count() == 0


def test_the_tricky_conversation(spark, sf_dir):
    row = op3_chat_formatting(spark, sf_dir).filter("conv_id = -7").first()
    text = f"user\n{TRICKY}\nassistant\n{TRICKY}\n"
    assert row.turns_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert row.loss_sha256 == hashlib.sha256(TRICKY.encode()).hexdigest() and row.loss_chars == len(TRICKY)


@pytest.fixture(scope="module")
def vocabulary():
    return MergeVocabulary(piece_model())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=40) | st.text("ab ▁\n.é", max_size=80), min_size=1, max_size=5))
def test_ids_and_decoding_equal_the_library(vocabulary, texts):
    library = sentencepiece.SentencePieceProcessor(model_proto=piece_model())
    ids = vocabulary.encode(texts)
    assert ids == [[*library.encode(t), library.eos_id()] for t in texts]
    assert vocabulary.decode(ids) == library.decode(ids)


def test_long_parts_use_the_heap(vocabulary):
    rng = random.Random(2)
    text = "".join(rng.choice("etaoinshrdlu") for _ in range(20_000))
    assert vocabulary.encode([text])[0] == [*vocabulary.library.encode(text), vocabulary.end_id]


def test_defined_results_of_coding(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "same words", "x"), (3, "same words", "x"), (None, " \n\ta", None)]
    out = encode_decode(spark.createDataFrame(rows, "doc_id long, text string, ids string"), piece_model(), keep=["doc_id"])
    got = sorted(((r.doc_id or 0, r.ids, r.decoded) for r in out.collect()), key=str)
    assert [g[2] for g in got] == [" \n\ta", "", "", "same words", "same words"]
    assert got[1][1] == got[2][1] == [2]
    assert encode_decode(spark.createDataFrame([], "doc_id long, text string"), piece_model()).count() == 0


def test_query_against_the_library(spark, sf_dir):
    library = sentencepiece.SentencePieceProcessor(model_proto=piece_model())
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op6_sentencepiece(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for row in rows:
        ids = [*library.encode(docs[row.doc_id]), library.eos_id()]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_formatting_uses_no_python(spark, cases):
    plan = chat.read_back(formatted(spark, cases)).withColumn("n", F.size("turns"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_ids_are_laid_out_flat_and_memory_keeps_its_bound():
    """Many cuts at once, over several generations; both comparisons notice a wrong id."""
    own = sentencepiece_bpe.MergeVocabulary(piece_model())
    own.known = sentencepiece_bpe.Memory(50)
    texts = ["", "one two", " ".join(f"w{i}ord" for i in range(300)), "a\n\n b\u20ac\U0001f600", "one two"]
    for _ in range(3):
        flat, bounds = own.encode_flat(texts)
        assert [flat[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [
            [*own.library.encode(t), own.end_id] for t in texts]
        assert len(own.known.young) <= 50 and len(own.known.old) <= 50
    assert own.decode_flat(flat, bounds) == texts
    met = own.known.among({"\u2581one", "never met"})
    assert set(met) <= {"\u2581one"}
    own.encode_many = lambda cuts: [(5,) for _ in cuts]
    with pytest.raises(ValueError, match="disagree on '\u2581zyx"):
        own.learn({"\u2581zyxwv", "\u2581zyxwvu"})


def test_slices_give_memory_back(monkeypatch):
    given = []
    monkeypatch.setattr(hashing, "give_back", lambda: given.append(1))
    batch = pa.RecordBatch.from_pydict({"text": ["x" * 100] * 64})
    assert sum(part.num_rows for part in hashing.slices(batch, 1_000)) == 64 and given == [1]
