"""Stemmers for German, Spanish, French and Portuguese (I10), by the published
suffix rules over the regions R1, R2 and RV. A word is stemmed by itself; callers stem each distinct term once.

R1 is what follows the first non-vowel after a vowel, R2 the same within R1. RV
differs by language. A suffix counts if it lies in its region as a whole.
"""

from __future__ import annotations

import re
from collections.abc import Callable


def _after(word: str, start: int, vowels: str) -> int:
    """Where the region after the next vowel and non-vowel from ``start`` begins."""
    m = re.compile(rf"[{vowels}][^{vowels}]").search(word, start)
    return m.end() if m else len(word)


class _Word:
    """A word with its regions, cut from the end."""

    def __init__(self, text: str, vowels: str, rv: int):
        self.text, self.vowels, self.rv = text, vowels, rv
        self.r1 = _after(text, 0, vowels)
        self.r2 = _after(text, self.r1, vowels)

    def longest(self, suffixes, start: int = 0) -> str | None:
        """The longest of the suffixes that lies right of ``start``."""
        found = [x for x in suffixes if self.text.endswith(x) and len(self.text) - len(x) >= start]
        return max(found, key=len, default=None)

    def lies(self, suffix: str, start: int) -> bool:
        return self.text.endswith(suffix) and len(self.text) - len(suffix) >= start

    def cut(self, suffix: str, to: str = "") -> None:
        self.text = self.text[:len(self.text) - len(suffix)] + to

    def cut_if(self, suffix: str, start: int, to: str = "") -> bool:
        if self.lies(suffix, start):
            self.cut(suffix, to)
            return True
        return False


# ---- German --------------------------------------------------------------------------------------

_DE = "aeiouyäöü"


def german(word: str) -> str:
    w = word.replace("ß", "ss")
    w = re.sub(rf"(?<=[{_DE}])([uy])(?=[{_DE}])", lambda m: m.group().upper(), w)
    x = _Word(w, _DE, 0)
    x.r1 = max(x.r1, min(3, len(w)))
    hit = x.longest(("em", "ern", "er", "e", "en", "es", "s"))
    if hit and x.lies(hit, x.r1):
        if hit != "s":
            x.cut(hit)
            if hit in ("e", "en", "es") and x.text.endswith("niss"):
                x.cut("s")
        elif x.text[-2:-1] in tuple("bdfghklmnrt"):
            x.cut("s")
    hit = x.longest(("en", "er", "est", "st"))
    if hit and x.lies(hit, x.r1) and (hit != "st" or (x.text[-3:-2] in tuple("bdfghklmnt") and len(x.text) >= 6)):
        x.cut(hit)
    hit = x.longest(("end", "ung", "ig", "ik", "isch", "lich", "heit", "keit"))
    if hit and x.lies(hit, x.r2):
        if hit in ("end", "ung"):
            x.cut(hit)
            if x.lies("ig", x.r2) and not x.text.endswith("eig"):
                x.cut("ig")
        elif hit in ("ig", "ik", "isch"):
            if not x.text.endswith("e" + hit):
                x.cut(hit)
        elif hit in ("lich", "heit"):
            x.cut(hit)
            for more in ("er", "en"):
                if x.cut_if(more, x.r1):
                    break
        else:
            x.cut(hit)
            for more in ("lich", "ig"):
                if x.cut_if(more, x.r2):
                    break
    return x.text.lower().translate(str.maketrans("äöü", "aou"))


# ---- Spanish and Portuguese ------------------------------------------------------------------------

def _rv(word: str, vowels: str) -> int:
    """RV of Spanish and Portuguese."""
    if len(word) < 3:
        return len(word)
    if word[1] not in vowels:
        m = re.compile(f"[{vowels}]").search(word, 2)
    elif word[0] in vowels:
        m = re.compile(f"[^{vowels}]").search(word, 2)
    else:
        return 3
    return m.end() if m else len(word)


_ES = "aeiouáéíóúü"
# Suffixes of Spanish.
_ES_PRONOUNS = ("me", "se", "sela", "selo", "selas", "selos", "la", "le", "lo", "las", "les", "los", "nos")
_ES_DELETE = ("anza anzas ico ica icos icas ismo ismos able ables ible ibles ista istas oso osa osos osas amiento amientos "
              "imiento imientos").split()
_ES_IC = "adora ador ación adoras adores aciones ante antes ancia ancias".split()
_ES_Y = "ya ye yan yen yeron yendo yo yó yas yes yais yamos".split()
_ES_EN = "en es éis emos".split()
_ES_VERB = ("arían arías arán arás aríais aría aréis aríamos aremos ará aré erían erías erán erás eríais ería eréis eríamos eremos "
            "erá eré irían irías irán irás iríais iría iréis iríamos iremos irá iré aba ada ida ía ara iera ad ed id ase iese aste "
            "iste an aban ían aran ieran asen iesen aron ieron ado ido ando iendo ió ar er ir as abas adas idas ías aras ieras ases "
            "ieses ís áis abais íais arais ierais aseis ieseis asteis isteis ados idos amos ábamos íamos imos áramos iéramos "
            "iésemos ásemos").split()


def _adverbs(x: _Word, mente: tuple, idade: tuple, iva: tuple, before_mente: tuple) -> bool:
    """The rules that Spanish and Portuguese share: -amente, -mente, -idad(e), -iva."""
    hit = x.longest(("amente", *mente, *idade, *iva))
    if hit is None:
        return False
    if hit == "amente":
        if not x.cut_if(hit, x.r1):
            return False
        if x.cut_if("iv", x.r2):
            x.cut_if("at", x.r2)
        else:
            any(x.cut_if(m, x.r2) for m in ("os", "ic", "ad"))
        return True
    if not x.cut_if(hit, x.r2):
        return False
    if hit in mente:
        any(x.cut_if(m, x.r2) for m in before_mente)
    elif hit in idade:
        any(x.cut_if(m, x.r2) for m in ("abil", "ic", "iv"))
    else:
        x.cut_if("at", x.r2)
    return True


def spanish(word: str) -> str:
    x = _Word(word, _ES, _rv(word, _ES))
    hit = x.longest(_ES_PRONOUNS, x.rv)
    if hit:
        rest = x.text[:len(x.text) - len(hit)]
        for ending in ("iéndo", "ándo", "ár", "ér", "ír"):
            if rest.endswith(ending) and len(rest) - len(ending) >= x.rv:
                x.text = rest[:len(rest) - len(ending)] + ending.translate(str.maketrans("áéí", "aei"))
                break
        else:
            if any(rest.endswith(e) and len(rest) - len(e) >= x.rv for e in ("ando", "iendo", "ar", "er", "ir")) or (
                    rest.endswith("uyendo") and len(rest) - 5 >= x.rv):
                x.text = rest
    before = x.text
    every = (*_ES_DELETE, *_ES_IC, "logía", "logías", "ución", "uciones", "encia", "encias", "amente", "mente", "idad", "idades", "iva", "ivo", "ivas", "ivos")
    hit = x.longest(every)
    if hit in _ES_DELETE:
        x.cut_if(hit, x.r2)
    elif hit in _ES_IC:
        if x.cut_if(hit, x.r2):
            x.cut_if("ic", x.r2)
    elif hit in ("logía", "logías"):
        x.cut_if(hit, x.r2, "log")
    elif hit in ("ución", "uciones"):
        x.cut_if(hit, x.r2, "u")
    elif hit in ("encia", "encias"):
        x.cut_if(hit, x.r2, "ente")
    elif hit:
        _adverbs(x, ("mente",), ("idad", "idades"), ("iva", "ivo", "ivas", "ivos"), ("ante", "able", "ible"))
    if x.text == before:
        hit = x.longest(_ES_Y, x.rv)
        if hit and x.text[:len(x.text) - len(hit)].endswith("u"):
            x.cut(hit)
        else:
            hit = x.longest((*_ES_EN, *_ES_VERB), x.rv)
            if hit:
                x.cut(hit)
                if hit in _ES_EN and x.text.endswith("gu"):
                    x.cut("u")
    hit = x.longest(("os", "a", "o", "á", "í", "ó", "e", "é"), x.rv)
    if hit:
        x.cut(hit)
        if hit in ("e", "é") and x.text.endswith("gu") and x.lies("u", x.rv):
            x.cut("u")
    return x.text.translate(str.maketrans("áéíóú", "aeiou"))


_PT = "aeiouáéíóúâêô"
# Suffixes of Portuguese (nasal vowels as a letter and a tilde).
_PT_DELETE = ("eza ezas ico ica icos icas ismo ismos ável ível ista istas oso osa osos osas amento amentos imento imentos adora "
              "ador aça~o adoras adores aço~es ante antes ância").split()
_PT_VERB = ("ada ida ia aria eria iria ará ara erá era irá ava asse esse isse aste este iste ei arei erei irei am iam ariam eriam "
            "iriam aram eram iram avam em arem erem irem assem essem issem ado ido ando endo indo ara~o era~o ira~o ar er ir as "
            "adas idas ias arias erias irias arás aras erás eras irás avas es ardes erdes irdes ares eres ires asses esses isses "
            "astes estes istes is ais eis íeis aríeis eríeis iríeis áreis areis éreis ereis íreis ireis ásseis ésseis ísseis áveis "
            "ados idos ámos amos íamos aríamos eríamos iríamos áramos éramos íramos ávamos emos aremos eremos iremos ássemos "
            "êssemos íssemos imos armos ermos irmos eu iu ou ira iras").split()


def portuguese(word: str) -> str:
    w = word.replace("ã", "a~").replace("õ", "o~")
    x = _Word(w, _PT, _rv(w, _PT))
    before = x.text
    every = (*_PT_DELETE, "logia", "logias", "uça~o", "uço~es", "ência", "ências", "amente", "mente", "idade", "idades", "iva", "ivo", "ivas", "ivos",
             "ira", "iras")
    hit = x.longest(every)
    if hit in _PT_DELETE:
        x.cut_if(hit, x.r2)
    elif hit in ("logia", "logias"):
        x.cut_if(hit, x.r2, "log")
    elif hit in ("uça~o", "uço~es"):
        x.cut_if(hit, x.r2, "u")
    elif hit in ("ência", "ências"):
        x.cut_if(hit, x.r2, "ente")
    elif hit in ("ira", "iras"):
        if x.lies(hit, x.rv) and x.text.endswith("e" + hit):
            x.cut(hit, "ir")
    elif hit:
        _adverbs(x, ("mente",), ("idade", "idades"), ("iva", "ivo", "ivas", "ivos"), ("ante", "avel", "ível"))
    if x.text == before:
        hit = x.longest(_PT_VERB, x.rv)
        if hit:
            x.cut(hit)
    if x.text != before:
        if x.lies("i", x.rv) and x.text.endswith("ci"):
            x.cut("i")
    else:
        hit = x.longest(("os", "a", "i", "o", "á", "í", "ó"), x.rv)
        if hit:
            x.cut(hit)
    hit = x.longest(("e", "é", "ê"), x.rv)
    if hit:
        x.cut(hit)
        if (x.text.endswith("gu") and x.lies("u", x.rv)) or (x.text.endswith("ci") and x.lies("i", x.rv)):
            x.text = x.text[:-1]
    elif x.text.endswith("ç"):
        x.cut("ç", "c")
    return x.text.replace("a~", "ã").replace("o~", "õ")


# ---- French ----------------------------------------------------------------------------------------

_FR = "aeiouyâàëéêèïîôûù"
# Suffixes of French.
_FR_DELETE = "ance iqUe isme able iste eux ances iqUes ismes ables istes".split()
_FR_IC = "atrice ateur ation atrices ateurs ations".split()
_FR_I = ("îmes ît îtes i ie ies ir ira irai iraIent irais irait iras irent irez iriez irions irons iront is issaIent issais issait "
         "issant issante issantes issants isse issent isses issez issiez issions issons it").split()
_FR_E = "é ée ées és èrent er era erai eraIent erais erait eras erez eriez erions erons eront ez iez".split()
_FR_A = "âmes ât âtes a ai aIent ais ait ant ante antes ants as asse assent asses assiez assions".split()


def _french_standard(x: _Word) -> tuple[bool, bool]:
    """Step 1: (whether it altered the word, whether the verb steps follow all the same)."""
    before = x.text
    groups = {"ement": ("ement", "ements"), "ité": ("ité", "ités"), "if": ("if", "ive", "ifs", "ives"), "euse": ("euse", "euses"),
              "isse": ("issement", "issements"), "ment": ("ment", "ments")}
    hit = x.longest((*_FR_DELETE, *_FR_IC, "logie", "logies", "usion", "ution", "usions", "utions", "ence", "ences", "eaux", "aux", "amment", "emment",
                     *(s for g in groups.values() for s in g)))
    if hit in _FR_DELETE:
        x.cut_if(hit, x.r2)
    elif hit in _FR_IC:
        if x.cut_if(hit, x.r2) and x.text.endswith("ic") and not x.cut_if("ic", x.r2):
            x.cut("ic", "iqU")
    elif hit in ("logie", "logies"):
        x.cut_if(hit, x.r2, "log")
    elif hit in ("usion", "ution", "usions", "utions"):
        x.cut_if(hit, x.r2, "u")
    elif hit in ("ence", "ences"):
        x.cut_if(hit, x.r2, "ent")
    elif hit in groups["ement"]:
        if x.cut_if(hit, x.rv):
            if x.cut_if("iv", x.r2):
                x.cut_if("at", x.r2)
            elif x.text.endswith("eus"):
                x.cut_if("eus", x.r2) or x.cut_if("eus", x.r1, "eux")
            elif x.text.endswith(("abl", "iqU")):
                x.cut_if("abl", x.r2) or x.cut_if("iqU", x.r2)
            elif x.text.endswith(("ièr", "Ièr")):
                x.cut_if(x.text[-3:], x.rv, "i")
    elif hit in groups["ité"]:
        if x.cut_if(hit, x.r2):
            if x.text.endswith("abil"):
                x.cut_if("abil", x.r2) or x.cut("abil", "abl")
            elif x.text.endswith("ic"):
                x.cut_if("ic", x.r2) or x.cut("ic", "iqU")
            else:
                x.cut_if("iv", x.r2)
    elif hit in groups["if"]:
        if x.cut_if(hit, x.r2) and x.cut_if("at", x.r2) and x.text.endswith("ic") and not x.cut_if("ic", x.r2):
            x.cut("ic", "iqU")
    elif hit == "eaux":
        x.cut("eaux", "eau")
    elif hit == "aux":
        x.cut_if(hit, x.r1, "al")
    elif hit in groups["euse"]:
        x.cut_if(hit, x.r2) or x.cut_if(hit, x.r1, "eux")
    elif hit in groups["isse"]:
        if x.lies(hit, x.r1) and x.text[:-len(hit)][-1:] not in tuple(_FR):
            x.cut(hit)
    elif hit in ("amment", "emment"):
        return x.cut_if(hit, x.rv, "ant" if hit == "amment" else "ent"), True
    elif hit in groups["ment"]:
        rest = x.text[:-len(hit)]
        if len(rest) - 1 >= x.rv and rest[-1:] in tuple(_FR):
            x.cut(hit)
            return True, True
    return x.text != before, x.text == before


def french(word: str) -> str:
    w = re.sub(r"(?<=q)u", "U", word)
    w = re.sub(rf"(?<=[{_FR}])([ui])(?=[{_FR}])", lambda m: m.group().upper(), w)
    w = re.sub(rf"(?<=[{_FR}])y|y(?=[{_FR}])", "Y", w)
    if w[:3] in ("par", "col", "tap"):
        rv = 3
    elif len(w) > 1 and w[0] in _FR and w[1] in _FR:
        rv = 3
    else:
        m = re.compile(f"[{_FR}]").search(w, 1)
        rv = m.end() if m else len(w)
    x = _Word(w, _FR, min(rv, len(w)))
    altered, verbs = _french_standard(x)
    if verbs:
        before = x.text
        hit = x.longest(_FR_I, x.rv)
        rest = x.text[:len(x.text) - len(hit)] if hit else ""
        if hit and len(rest) - 1 >= x.rv and rest[-1:] not in tuple(_FR):
            x.cut(hit)
            altered = True
        else:
            hit = x.longest(("ions", *_FR_E, *_FR_A), x.rv)
            if hit == "ions":
                x.cut_if(hit, x.r2)
            elif hit in _FR_E:
                x.cut(hit)
            elif hit:
                x.cut(hit)
                x.cut_if("e", x.rv)
            altered = altered or x.text != before
    if altered:
        if x.text.endswith("Y"):
            x.cut("Y", "i")
        elif x.text.endswith("ç"):
            x.cut("ç", "c")
    else:
        if x.text.endswith("s") and x.text[-2:-1] not in tuple("aiouès"):
            x.cut("s")
        hit = x.longest(("ion", "ier", "ière", "Ier", "Ière", "e"), x.rv)
        if hit == "ion":
            rest = x.text[:-3]
            if x.lies("ion", x.r2) and len(rest) - 1 >= x.rv and rest[-1:] in ("s", "t"):
                x.cut("ion")
        elif hit == "e":
            x.cut("e")
        elif hit:
            x.cut(hit, "i")
    if x.text.endswith(("enn", "onn", "ett", "ell", "eill")):
        x.text = x.text[:-1]
    x.text = re.sub(rf"[éè](?=[^{_FR}]+$)", "e", x.text)
    return x.text.lower()


STEMMERS: dict[str, Callable[[str], str]] = {"de": german, "es": spanish, "fr": french, "pt": portuguese}
