import random
import zlib

import numpy as np
import pytest
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeloom.llm import elias_fano, token_store as S
from lakeloom.llm.common import shared_path

PATH = public_tokenizers.path("word_bpe_49k.json")


@given(st.lists(st.integers(0, 1 << 40), max_size=700).map(sorted))
@settings(max_examples=60, deadline=None)
def test_elias_fano_round_trip(values):
    code = elias_fano.EliasFano(elias_fano.encode(values))
    assert code.values().tolist() == values and len(code) == len(values)
    assert [code.select(i) for i in range(len(values))] == values


def test_elias_fano_space_and_order():
    values = np.cumsum(np.random.default_rng(1).integers(1, 600, 20_000))
    assert len(elias_fano.encode(values)) * 8 < 20_000 * (2 + np.log2(values[-1] / 20_000) + 1)
    with pytest.raises(ValueError):
        elias_fano.encode([3, 2])
    with pytest.raises(IndexError):
        elias_fano.EliasFano(elias_fano.encode([1])).select(1)


@given(st.lists(st.text(alphabet=st.sampled_from("aZéÀßÿĀſŁ×İı,,..́İΣς's 9_.<|endoftxt>\n\t\x0b\x1c  漢") | st.characters(exclude_categories=["Cs"]),
                        max_size=60), max_size=8))
@settings(max_examples=150, deadline=None)
def test_words_give_the_ids_of_the_whole_text(texts):
    whole = Tokenizer.from_file(PATH)
    got = S.WordEncoder(PATH)(texts)
    assert [np.frombuffer(g, "<u2").tolist() for g in got] == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_store_round_trip(spark, monkeypatch):
    rnd = random.Random(2)
    words = ["the", "It's", "<|endoftext|>", "naïve", "...", "x" * 90]
    rows = [(i * 7 - 300, " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 60))), 1) for i in range(400)]
    rows += [(5, None, 1), (5, "", 2), (None, "no id", 1), (None, None, 2), (5, "the the", 3), (1 << 40, "the " * 150_000, 1)]
    rnd.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int").withColumn("start", F.lit("x"))
    path = shared_path(spark, "test-store")
    S.write_store(docs, path, lambda: S.WordEncoder(PATH), end_id=1)
    whole = Tokenizer.from_file(PATH)
    want, at = [], 0
    for d, t, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = whole.encode(t or "", add_special_tokens=False).ids + [1]
        want.append((d, at, len(ids), ids))
        at += len(ids)
    got = sorted(S.read_store(spark, path).collect(), key=lambda r: r.start)
    assert [tuple(r) for r in got] == want
    crcs = {r.start: r.ids_crc32 for r in S.read_digests(spark, path).collect()}
    assert crcs == {s: zlib.crc32(np.array(i, "<u4").tobytes()) for _, s, _, i in want}


def test_empty_store(spark):
    path = shared_path(spark, "test-store")
    S.write_store(spark.createDataFrame([], "doc_id long, text string"), path, lambda: S.WordEncoder(PATH), end_id=1)
    assert S.read_store(spark, path).collect() == []


def test_tasks_of_a_worker_share_one_encoder():
    assert S.word_encoder(PATH) is S.word_encoder(PATH)
    assert S.word_encoder(PATH)(["a word"]) == S.WordEncoder(PATH)(["a word"])
