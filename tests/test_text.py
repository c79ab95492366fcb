import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from canon_reference import LATIN as _LATIN
from canon_reference import py_canon as _py_canon
from zonekit.functions.text import FOLD_FROM, FOLD_TO, basic_norm, canon


def _one(spark, fn, s):
    return spark.createDataFrame([(s,)], "x string").select(fn(F.col("x")).alias("y")).first().y


def test_fold_table_is_one_to_one_and_ascii(spark):
    assert len(FOLD_FROM) == len(FOLD_TO) > 100
    assert all("a" <= c <= "z" for c in FOLD_TO)


def test_canon_accents_nfc_and_nfd_agree(spark):
    nfc = "Sants-Montjuïc"
    nfd = unicodedata.normalize("NFD", nfc)
    assert nfc != nfd
    assert _one(spark, canon, nfc) == _one(spark, canon, nfd) == "sants montjuic"


def test_canon_punctuation_spaces_quotes(spark):
    cases = {
        "la Nova Esquerra de l'Eixample": "la nova esquerra de l eixample",
        "Sant Pere – Santa Caterina": "sant pere santa caterina",
        "Ciutat Vella": "ciutat vella",
        '"Horta, Barcelona"': "horta barcelona",
        "  El   Raval  ": "el raval",
    }
    for raw, want in cases.items():
        assert _one(spark, canon, raw) == want


def test_canon_multi_letter_folds(spark):
    assert _one(spark, canon, "Straße") == _one(spark, canon, "STRASSE") == "strasse"
    assert _one(spark, canon, "Cœur-Æther") == "coeur aether"


def test_basic_norm_is_the_reference_behaviour(spark):
    # combining marks are stripped, precomposed letters stay
    assert _one(spark, basic_norm, "Sants-Montjuïc") == "sants-montjuïc"
    assert _one(spark, basic_norm, unicodedata.normalize("NFD", "Sants-Montjuïc")) == "sants-montjuic"


@settings(max_examples=25, deadline=None)
@given(st.text(alphabet=st.characters(min_codepoint=32, max_codepoint=0x024F), max_size=30))
def test_canon_idempotent(spark, s):
    once = _one(spark, canon, s)
    assert _one(spark, canon, once) == once


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet=_LATIN, max_size=25), min_size=1, max_size=20))
def test_canon_equals_unicode_decomposition_reference(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.c for r in df.select("i", canon("t").alias("c")).collect()}
    assert got == {i: _py_canon(t) for i, t in enumerate(texts)}
