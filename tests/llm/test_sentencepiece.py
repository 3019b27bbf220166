import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as pb

from lakeloom.llm import sentencepiece_codec as S

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = S.PieceModel(PATH)


def lattice(text, m=MODEL):
    """The whole lattice at once, ends in order, starts from the left."""
    s = m.normalise(text)
    best = [0.0] + [None] * len(s)
    back = [None] * (len(s) + 1)
    for e in range(1, len(s) + 1):
        for q in range(max(0, e - m.longest), e):
            i = m.ids.get(s[q:e])
            score = m.scores[i] if i is not None else m.unknown if e == q + 1 else None
            if score is not None and best[q] is not None and (best[e] is None or best[q] + score > best[e]):
                best[e], back[e] = best[q] + score, (q, i)
    out, p = [], len(s)
    while p:
        q, i = back[p]
        out.extend([i] if i is not None else [m.byte_ids[b] for b in reversed(s[q:p].encode())])
        p = q
    return out[::-1]


def ints(data):
    return [int.from_bytes(data[i:i + 4], "little") for i in range(0, len(data), 4)]


TEXTS = st.text(alphabet=st.sampled_from("abcdehinorstAT  \n\t.,'0é漢▁\x00") | st.characters(exclude_categories=["Cs"]), max_size=120)


@given(st.lists(TEXTS, max_size=4))
@settings(max_examples=200, deadline=None)
def test_streaming_equals_the_whole_lattice(texts):
    got = [ints(c) for c in ENCODER(texts)]
    assert got == [lattice(t) for t in texts]
    for t, ids in zip(texts, got):
        assert MODEL.decode(ids) == t.replace(S.MARK, " ")


ENCODER = S.PieceEncoder(PATH)


@given(TEXTS, st.integers(1, 9))
@settings(max_examples=100, deadline=None)
def test_chunks_do_not_matter(text, size):
    coder = S.StreamingViterbi(MODEL)
    normal = MODEL.normalise(text)
    for i in range(0, len(normal), size):
        coder.feed(normal[i:i + size])
    assert coder.finish() == lattice(text)


def test_window_stays_small_on_a_long_text_without_spaces():
    rnd = random.Random(4)
    text = "".join(rnd.choice("thequickbrown") for _ in range(30_000))
    coder = S.StreamingViterbi(MODEL)
    widest = 0
    for i in range(0, len(text), 64):
        coder.feed(text[i:i + 64])
        widest = max(widest, len(coder.pending))
    assert widest < 1000 and MODEL.decode(coder.finish()) == text


def test_words_as_the_library_cuts_them(tmp_path):
    """The same pieces and scores as a unigram model of the library itself."""
    proto = pb.ModelProto()
    proto.ParseFromString(open(PATH, "rb").read())
    proto.trainer_spec.model_type = 1
    (tmp_path / "uni.model").write_bytes(proto.SerializeToString())
    sp = sentencepiece.SentencePieceProcessor(model_file=str(tmp_path / "uni.model"))
    rnd = random.Random(8)
    for _ in range(500):
        word = "".join(rnd.choice("aeiounrstlhdTA.é") for _ in range(rnd.randint(1, 14)))
        assert sp.encode(word) == lattice(word) == ints(ENCODER([word])[0]), word


def test_tables(spark):
    rows = [(1, None, 3), (1, "", 3), (2, "It is  a\n\n test\t▁ 漢字 \U0001f600", 3), (None, "null id", 3),
            (3, "long " * 40_000, 3), (2, "tie", 3), (2, "tie", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int").withColumn("n_tokens", F.lit("x"))
    out = S.encode_table(docs, PATH, verify=True).collect()
    assert sorted((str(r.doc_id), r.ids) for r in out) == sorted((str(d), lattice(t or "")) for d, t, _ in rows)
    assert all(r.n_tokens == len(r.ids) for r in out)
    assert [r.round_trip for r in out if r.doc_id == 2 and r.n_tokens > 9] == [False]
    assert all(r.round_trip for r in out if r.doc_id != 2)
    coded = S.encode_table(docs, PATH).withColumn("ids", F.when(F.col("n_tokens") > 0, F.col("ids")))
    back = S.decode_table(coded, PATH).collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted(
        (str(d), (t or "").replace("▁", " ")) for d, t, _ in rows)
    assert S.encode_table(docs.limit(0), PATH, verify=True).collect() == []


@pytest.mark.parametrize("text,spans", [("a b\nc", ["▁a", "▁b", "\n", "c"]), ("a \n b", ["▁a", "▁", "\n", "▁b"])])
def test_spans(text, spans):
    assert [s for s in S._simple(text) if s] == spans


@pytest.mark.parametrize("text", [" ver", " ing", " ver ver", " \nver", "\n ver", " ", " a"])
def test_a_leading_space_joins_the_mark_in_front(text):
    assert ints(ENCODER([text])[0]) == lattice(text)


def test_scores_are_kept_since_the_last_commit_only():
    rnd = random.Random(5)
    coder = S.StreamingViterbi(MODEL)
    kept = []
    for _ in range(2_000):
        coder.feed("".join(rnd.choice("thequickbrown") for _ in range(16)))
        kept.append(max(len(coder.best), len(coder.start), len(coder.piece)))
    # the text that is looked over at once, the chunk, and the pieces that reach on
    assert max(kept) <= 2 * (4 * MODEL.longest) + 16 + 2 * MODEL.longest and coder.committed


def test_tasks_of_a_worker_share_one_encoder():
    assert S.piece_encoder(PATH) is S.piece_encoder(PATH)
    assert S.piece_encoder(PATH)(["several new words"]) == S.PieceEncoder(PATH)(["several new words"])
