"""Word lists of the text operators, and what is derived from them."""

from __future__ import annotations

import re
from collections.abc import Iterator

#: A word: a longest run of letters and digits.
WORD = re.compile(r"[^\W_]+")

#: Common function words of the languages that are told apart.
COMMON = {
    "en": "a about above across after again all although an and another any are as at be because been before behind below beside between beyond both but by can close could did do does each every few for from had has have he her his how i if in inside into is it its just me more most my near nearby no nobody not of often on one only or other our out over people she should so some such than that the their them then there these they this those through time to under until up was we well were what when where which while who why will with would you your".split(),
    "fr": "a alors au aussi aux avec bien car ce ces cette chaque comme comment dans de derrière des du elle en encore entre est et eux il ils je la le les leur lui mais même mes mon ne nos notre nous on ont ou où par parce pas personne peu plus pour près puis quand que quelle qui quoi sa sans se selon ses si son sont sous sur toujours tous tout très tu un une vers vos votre vous y été".split(),
    "de": "aber alle als am an auch auf aus bei beinahe bin bis da dann das dass dem den denn der des die diese dieser doch du durch ein eine einem einen einer er es falls für hat haben hinter ich ihr im immer in ist ja jede jeder kein man mit nach neben nicht niemand noch nur ob obwohl oder ohne ihre seit sehr sein seine sich sie sind so trotz um und unter vom von vor war warum was weil wenn wer werden wie wir wird wo zu zum zur zwischen über".split(),
    "es": "a al algo ante aquel aunque bajo cada cerca como con cuando cuál cómo de del desde detrás donde dos durante e el ella en entonces entre era es esa ese eso esta este fue gente ha hace han hasta hay la las le les lo los luego me mi mientras muy más nada nadie ni no nos o otra otro para pero poco por porque que quien qué se según ser si siempre sin sobre son su sus también te tiene todo tras tu un una y ya él".split(),
}

#: Names of the languages, in the languages.
LANGUAGE_NAMES = {
    "en": "english anglais englisch englische englischen inglés inglesa inglese".split(),
    "fr": "french français française französisch französische französischen francés francesa".split(),
    "de": "german allemand allemande deutsch deutsche deutschen alemán alemana".split(),
    "es": "spanish espagnol espagnole spanisch spanische spanischen español española castellano".split(),
}

#: word -> the languages whose lists hold it.
LANGUAGES_OF: dict[str, tuple[str, ...]] = {}
for _lang, _list in COMMON.items():
    for _w in _list:
        LANGUAGES_OF[_w] = (*LANGUAGES_OF.get(_w, ()), _lang)

ALL_COMMON = frozenset(LANGUAGES_OF)


def words(text: str | None) -> list[str]:
    """The words of ``text`` in order, lower-cased; none for null."""
    return WORD.findall(text.lower()) if text else []


def portions(texts: list[str | None], most_chars: int = 1_000_000, most_texts: int = 1000) -> Iterator[tuple[int, int]]:
    """``(start, end)`` of stretches of ``texts`` of at most so many characters and texts, so that what is held doesn't follow the longest texts; a longer text is alone."""
    start = chars = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and (chars + n > most_chars or i - start >= most_texts):
            yield start, i
            start, chars = i, 0
        chars += n
    if start < len(texts):
        yield start, len(texts)
