import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from curbside.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  a", "a  b", "a b ", "a\n b", "日本語 テキスト", "<s> </s> <unk> <0x0A>", "▁x ▁▁", "  　é", "𝒳 🙂", "x" * 500, "a\x00b c", "\t\t"]


@pytest.fixture(scope="module")
def model():
    return pieces.Model(PATH)


def samples():
    rng = random.Random(1)
    return ODD + ["".join(rng.choice(["a", " ", "é", "\n", "the", "🙂", "▁", "ing "]) for _ in range(30)) for _ in range(300)]


def test_equals_the_library(model, spark, sf):
    assert model.by_word
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    texts = samples() + [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    for text in texts:
        ids, ends = model.encode(text)
        want = library.encode(text, add_bos=True, add_eos=True)
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert model.decode(ids) == library.decode(want)
        same = model.encode_whole(text)
        assert same[0] == ids and same[1].tolist() == ends.tolist()
        found = library.encode(text, return_type="proto").pieces
        for p, end in zip(found, ends.tolist(), strict=True):
            if p.id not in model.byte_ids:
                assert p.end == end


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "identity"])
@pytest.mark.parametrize("trim", [True, False])
def test_character_map_equals_the_librarys(rule, trim):
    own = sentencepiece.SentencePieceNormalizer(
        rule_name=rule, add_dummy_prefix=True, escape_whitespaces=True, remove_extra_whitespaces=trim)
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(own.serialized_model_proto())
    spec = proto.normalizer_spec
    spec.add_dummy_prefix, spec.escape_whitespaces, spec.remove_extra_whitespaces = True, True, trim
    normalize = pieces.Normalizer(spec)
    for text in [*samples(), "ﬁ ① ＡＢ ｶﾞ é ㌔ Straße­", "  　 x  y "]:
        data, places = normalize(text)
        want, _ = own.normalize(text, with_offsets=True)
        assert data.decode() == want, text
        assert len(places) == len(data) + 1 and places == sorted(places) and places[-1] <= len(text.encode())


def test_rows(spark):
    docs = spark.createDataFrame([(1, None), (1, ""), (None, "a é"), (2, "b " * 40_000)], "doc_id long, text string")
    rows = pieces.digests(docs, PATH).collect()
    empty = np.array([1, 2], "<u4").tobytes()
    assert [r.ids_sha256 for r in rows[:2]] == [hashlib.sha256(empty).hexdigest()] * 2
    assert rows[2].decoded_sha256 == hashlib.sha256("a é".encode()).hexdigest()
    full = pieces.encoded(docs, PATH)
    assert [r.text for r in pieces.decoded(full, PATH).collect()] == ["", "", "a é", "b " * 40_000]
    spans = full.filter("doc_id is null").first()
    assert spans.ends[-1] == 4 and len(spans.starts) == len(spans.ends) == len(spans.ids) - 2
    assert pieces.digests(docs.limit(0), PATH).count() == 0


def test_runs_of_an_empty_map_are_recorded_like_characters():
    import copy
    import random

    import public_tokenizers

    from curbside.llm.pieces import MARK, Model

    model = Model(public_tokenizers.path("piece_bpe_32k.model"))
    assert model.normalizer.runs and model.by_word
    slow = copy.copy(model.normalizer)
    slow.runs = False
    rng = random.Random(8)
    for _ in range(500):
        text = "".join(rng.choice(["a", "bc", "é", "日本", "𝒳", " ", "  ", "\n", "\t", MARK]) for _ in range(rng.randrange(12)))
        assert model.normalizer(text) == slow(text)
        ids, ends = model.encode(text)
        if text:
            whole, same = model.encode_whole(text)
            assert ids == whole and ends.tolist() == same.tolist()
