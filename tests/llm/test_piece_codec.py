import hashlib
import random

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import piece_codec as pc


@pytest.fixture(scope="module")
def model():
    return pc.load(pc.model_path())


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pc.model_path())


TEXTS = ["", " ", "  a", "a  b ", "▁x", "a\nb\tc", "　é​中\U0001F600", "<s>x</s><unk><0x0A>",
         "\x00a", " " * 100, "a" * 1000, "▁" * 7 + " ▁b", "ab" * 300, "1234567890" * 20, "x².”y", "\r\n.\r",
         "https://x.y/z?a=b&c=d", "Ünïcödé straße 北京大学 русский язык हिन्दी"]


@pytest.mark.parametrize("text", TEXTS)
def test_texts(model, library, text):
    ids = model.encode(text)
    assert ids == library.encode(text)
    assert model.decode(ids) == library.decode(ids)


@settings(max_examples=800, deadline=None)
@given(st.text(max_size=60))
def test_any_text(model, library, text):
    assert model.encode(text) == library.encode(text)
    assert model.decode(model.encode(text)) == library.decode(library.encode(text))


@settings(max_examples=800, deadline=None)
@given(st.text(alphabet="  ▁\naeht.,'0é中\r", max_size=60))
def test_texts_of_few_characters(model, library, text):
    assert model.encode(text) == library.encode(text)


def test_texts_of_pieces(model, library):
    rng, pieces = random.Random(1), list(model.ids)
    for _ in range(3000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(1, 30)))
        text = text.replace("▁", rng.choice([" ", "▁", "  ", "\n"]))
        assert model.encode(text) == library.encode(text)


def test_any_ids_decode_as_in_the_library(model, library):
    rng = random.Random(2)
    some = [*library.encode("é中😀� x"), 28705, 259, 264, 0, 1, 2]
    for _ in range(5000):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(262), *some]) for _ in range(rng.randint(0, 12))]
        assert model.decode(ids) == library.decode(ids), ids


def test_compatibility_is_what_merging_gives(model):
    rng, pieces = random.Random(3), list(model.ids)
    near = [p for p in pieces if len(p) < 4]
    for _ in range(20_000):
        a, b = rng.choice(pieces), rng.choice(near if rng.random() < 0.7 else pieces)
        assert model.compatible(a, b) == (model.merged(a + b)[0] == [a, b]), (a, b)


def test_prefix_table_holds_the_last_token_of_every_prefix(model):
    for text in ("▁internationalisation", "▁▁▁▁x中é", "ttttthe"):
        last = model.last_tokens(text)
        for k in range(1, len(text) + 1):
            assert last[k] == model.merged(text[:k])[0][-1]


def test_bounded_tables_change_nothing(library, monkeypatch):
    monkeypatch.setattr(pc, "MAX_UNITS", 20)
    monkeypatch.setattr(pc, "MAX_PAIRS", 30)
    small = pc.PieceModel(pc.model_path())
    text = " ".join(f"word{i} Straße {i * 37}% of it" for i in range(300))
    assert small.encode(text) == library.encode(text)
    assert len(small._known) <= 20 and small.n_pairs <= 31


def test_query(spark, library, tmp_path):
    long = "Ein sehr langer Text. " * 20_000 + "ä" * 50_000
    rows = [(1, "a b"), (1, "a b"), (2, None), (3, ""), (None, long), (4, "▁ x\n\n  y ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "doc_id", "text", "1 as ids", "2 as decoded", "3 as n_tokens"
    )
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    check(pc.op11(spark, str(tmp_path)), rows, library)


def test_whole_table(spark, library):
    path = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()]
    check(pc.op11(spark, path), rows, library)


def check(df, rows, library):
    def row(doc_id, text):
        ids = library.encode(text or "", add_eos=True)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        return doc_id, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids))

    assert sorted(map(tuple, df.collect()), key=str) == sorted((row(*r) for r in rows), key=str)
    assert df.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_round_trip_of_columns(spark):
    docs = spark.createDataFrame([(7, " Zwei  Wörter\n", "x")], "doc_id long, text string, z string")
    got = pc.decode(pc.encode(docs, end_id=False, keep=("z", "text"))).first()
    assert got.decoded == got.text and got.z == "x" and 2 not in got.ids
    none = spark.createDataFrame([(None,)], "ids array<int>")
    assert pc.decode(none).first().decoded == ""
    assert pc.encode(docs.limit(0)).count() == 0 == pc.decode(none.limit(0)).count()


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as pb2

    proto = pb2.ModelProto()
    proto.trainer_spec.model_type = pb2.TrainerSpec.UNIGRAM
    (tmp_path / "m").write_bytes(proto.SerializeToString())
    with pytest.raises(ValueError):
        pc.PieceModel(str(tmp_path / "m"))
