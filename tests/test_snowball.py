"""Golden stems of four languages, and stemming by language on tables."""

import pytest

from quire.functions import snowball as S
from quire.operators import tokens as T

GOLDEN = {
    "de": {"aufeinander": "aufeinand", "aufgeblasen": "aufgeblas", "kategorische": "kategor", "katers": "kat", "aufenthalt": "aufenthalt",
           "häuser": "haus", "freundlich": "freundlich", "zeitung": "zeitung", "bedeutungen": "bedeut", "ergebnisse": "ergebnis", "straße": "strass"},
    "es": {"cheques": "chequ", "chicana": "chican", "chicharrones": "chicharron", "chilenas": "chilen", "torneo": "torne", "toreado": "tor",
           "torearlo": "tor", "tórax": "torax", "torres": "torr", "rápidamente": "rapid", "naciones": "nacion", "paguen": "pag"},
    "fr": {"continua": "continu", "continuait": "continu", "continuelle": "continuel", "continuellement": "continuel", "contradictions": "contradict",
           "majestueuses": "majestu", "maison": "maison", "chevaux": "cheval", "constamment": "const", "naturellement": "naturel", "finissait": "fin"},
    "pt": {"boataria": "boat", "boatos": "boat", "boicotado": "boicot", "quilométricas": "quilométr", "quilos": "quil", "química": "químic",
           "quinhão": "quinhã", "rapidamente": "rapid", "liberdades": "liberdad"},
}


@pytest.mark.parametrize("lang", GOLDEN)
def test_golden_stems(lang):
    assert {w: S.STEMMERS[lang](w) for w in GOLDEN[lang]} == GOLDEN[lang]


@pytest.mark.parametrize("lang", S.STEMMERS)
def test_short_and_odd_words_do_not_fail(lang):
    for w in ("", "a", "y", "ée", "ss", "ß", "qu", "1990", "漢字", "e" * 300, "s", "niss"):
        assert isinstance(S.STEMMERS[lang](w), str)


def test_tokens_are_stemmed_in_their_language(spark):
    toks = spark.createDataFrame([(1, 1, "häuser"), (1, 2, "katers"), (1, 3, "häuser")], "doc_id long, pos int, term string")
    got = sorted((r.pos, r.term) for r in T.tokens_wordstem(toks, lang="de").collect())
    assert got == [(1, "haus"), (2, "kat"), (3, "haus")]
    with pytest.raises(ValueError):
        T.stem_map(toks, lang="xx")
