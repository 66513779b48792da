"""Defects of prompt and response pairs.

Each pair is looked at on its own, in Arrow batches without a shuffle. The checks, in this order:

* ``empty``: nothing but blanks, invisible characters, template marks or a stand-in such as ``n/a``;
* ``copy``: the prompt's words are put into a *suffix automaton*, the response is led through it, and
  the words covered by matches of three words or more (shorter only if the response is) are counted:
  at least 0.8 of the response must be copied and at least 0.6 of the prompt be given back;
* ``refusal``: an *automaton* over classes of words finds the sentences that decline (someone speaks of
  himself, negates, and names an act of help or speech; or names his rules and what they forbid);
  nothing but these, polite openings and closings may remain;
* ``language``: every sentence votes with its function words for a language; more than half of the
  words that are decided must be in a language other than the prompt's that the prompt doesn't name;
* ``truncated``: the *stack of delimiters* isn't empty at the end, or the text doesn't end as a
  sentence does. Lists, tables, junk and very short answers don't end in sentences and are exempt.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from quern.llm.lexicon import LANGUAGE_NAMES, LANGUAGES_OF, words
from quern.llm.quality import _BULLET, describe
from quern.session import fresh

#: Words that alone stand for an answer that isn't there.
STAND_INS = frozenset("na null none nil nan empty blank undefined missing tbd todo placeholder pending void leer vide vacío keine aucune ninguna".split())
#: What may be said to be missing, in which words, and what may stand beside these.
_NOTHING = frozenset("no not none empty blank missing without null insert placeholder pending unavailable keine kein ohne nicht leere aucune aucun pas sans vide sin ninguna ningún no vacía".split())
_WHAT = frozenset("answer answers response reply text content output result available applicable provided given data value message completion generated returned found antwort text inhalt angabe angaben vorhanden verfügbar réponse texte contenu disponible donnée respuesta texto contenido dato datos disponible".split())
_BESIDE = frozenset("the a an is was here your to be yet been of der die das ist hier la le el de est es aquí".split())
_MARK = re.compile(r"<\|[a-z_]+\|>|</?s>|\[/?inst\]|</?(?:p|br|div)\s*/?>", re.I)
_INVISIBLE = re.compile(r"[\s\u00ad\u200b-\u200f\u2028-\u202f\u2060\ufeff]+")

#: Classes of words, by language, from which patterns of declining are made; ``t`` is what is left of *can't*.
CLASSES = {
    "en_self": "i we me us my our",
    "en_not": "t not cannot unable never nothing no incapable",
    "en_act": "help assist assistance aid answer answers respond response reply provide give offer share supply discuss talk speak comment say tell write generate create produce draft compose complete fulfil fulfill comply engage support advise advice address explain describe elaborate disclose reveal continue proceed process handle honour honor entertain cover weigh opinion information guidance service oblige accommodate contribute browse access helping assisting answering responding replying providing giving offering sharing discussing talking speaking commenting saying telling writing generating creating complying advising explaining describing disclosing",
    "en_refuse": "decline declining refuse refusing abstain refrain refraining withhold",
    "en_prefer": "rather prefer",
    "en_neg": "not",
    "en_may": "permitted allowed authorized authorised comfortable willing able appropriate possible prepared ready equipped designed supposed meant liberty position going",
    "en_ill": "inappropriate improper unethical impossible unwise irresponsible",
    "en_rules": "guidelines guideline policy policies rules rule programming instructions principles restrictions developers safeguards scope abilities capabilities remit limits",
    "en_own": "my our",
    "en_forbid": "prevent prevents forbid forbids prohibit prohibits restrict restricts stop stops bar bars disallow disallows rule against exclude excludes",
    "en_over": "against violates violate violating outside beyond conflicts contrary breach breaches off",
    "en_do": "do",
    "en_that": "that this so it these those",
    "en_have": "have got possess",
    "en_lack": "ability access permission authority clearance means right freedom answer comment information",
    "en_leave": "leave skip pass stay keep remain steer stand",
    "en_silent": "unanswered silent out quiet aside one away clear alone mum",
    "en_go": "get go dig dive wade",
    "en_into": "into",
    "en_lacks": "lack lacks without",
    "en_what": "what",
    "en_no": "no",
    "en_comment": "comment comments",
    "en_told": "told asked instructed advised trained designed built programmed meant",
    "en_to": "to",
    "en_off": "off out",
    "en_limits": "limits table bounds reach",
    "en_closed": "closed barred forbidden prohibited",
    "en_can": "can could may might would",
    "en_be": "be",
    "en_done": "discussed answered provided shared given disclosed addressed explained helped revealed covered",
    "fr_self": "je j me m nous moi",
    "fr_ne": "ne n",
    "fr_pas": "pas point guère plus rien aucune aucun",
    "fr_act": "aider aide répondre réponse fournir donner parler dire discuter traiter écrire rédiger commenter assister partager proposer expliquer accéder poursuivre satisfaire aborder communiquer produire exprimer prononcer renseigner conseiller évoquer ajouter faire",
    "fr_refuse": "refuse refuser refusons décline décliner abstiens abstenir renonce renoncer",
    "fr_prefer": "préfère préférons préférerais aime aimerais voudrais",
    "fr_may": "autorisé autorisée mesure capable habilité habilitée droit permis permise possible possibilité",
    "fr_ill": "impossible impossibilité interdit interdite inapproprié déplacé",
    "fr_own": "mes mon nos notre ma",
    "fr_rules": "règles règle consignes directives principes instructions politique règlement limites programmation",
    "fr_forbid": "pas interdisent interdit empêchent empêche",
    "fr_silent": "silence",
    "fr_keep": "garder garde garderai",
    "fr_can": "saurais saurait pouvoir puis",
    "fr_without": "sans",
    "fr_comment": "commentaire commentaires réponse",
    "de_self": "ich mir mich wir uns",
    "de_not": "nicht nichts kein keine keinen keinerlei unmöglich",
    "de_act": "helfen beantworten antworten sagen geben liefern besprechen reden sprechen schreiben erklären unterstützen äußern bereitstellen weiterhelfen mitteilen behandeln erfüllen eingehen diskutieren verfassen auskunft antwort antworte helfe dienen beitragen nachkommen beraten machen",
    "de_refuse": "ablehnen verweigern lehne verweigere ablehne enthalten enthalte zurückweisen absehen passen schweige schweigen",
    "de_prefer": "lieber",
    "de_may": "erlaubt gestattet befugt berechtigt möglich imstande lage angebracht darf zuständig zu",
    "de_own": "meine meinen meiner mein unsere unseren",
    "de_rules": "richtlinien regeln vorgaben grundsätze anweisungen leitlinien bestimmungen programmierung",
    "de_forbid": "nicht verbieten untersagen verhindern kein keine",
    "de_against": "gegen außerhalb",
    "es_no": "no",
    "es_can": "puedo podemos podré podría quiero queremos voy debo debemos deseo sé logro estoy soy tengo",
    "es_act": "ayudar ayudarte ayudarle ayudarlo ayudarla ayuda responder responderte responderle contestar contestarte dar darte darle ofrecer ofrecerte proporcionar proporcionarte hablar decir decirte discutir escribir comentar compartir explicar atender tratar redactar generar asistir asistirte opinar facilitar continuar cumplir respuesta hacer hacerlo pronunciarme",
    "es_refuse": "niego negarme rehúso rehusar rechazo rechazar declino declinar abstengo abstenerme excuso eludir",
    "es_prefer": "prefiero preferimos preferiría",
    "es_me": "me nos",
    "es_may": "permitido permitida autorizado autorizada permiten permite capaz posible facultado condiciones",
    "es_ill": "imposible inapropiado inadecuado prohibido",
    "es_own": "mis mi nuestras",
    "es_rules": "normas reglas directrices políticas política pautas principios instrucciones programación límites",
    "es_forbid": "no impiden impide prohíben prohíbe",
    "es_against": "contra fuera",
    "es_nothing": "nada",
    "es_fit": "corresponde compete toca incumbe",
    "es_able": "poder",
    "es_without": "sin",
    "es_comment": "comentarios comentario",
    "de_none": "kein keinen",
    "de_comment": "kommentar",
}
#: Sequences of classes that decline; a number is the most words between two of them.
PATTERNS = [
    "en_self 4 en_not 5 en_act", "en_self 4 en_refuse", "en_self 3 en_prefer 1 en_neg", "en_self 3 en_not 1 en_do 0 en_that", "en_not 3 en_may 6 en_act", "en_not 1 en_may 2 en_self", "en_not 3 en_self 2 en_may", "en_ill 2 en_self",
    "en_own 1 en_rules 6 en_not", "en_own 1 en_rules 6 en_forbid", "en_over 3 en_rules", "en_self 4 en_not 1 en_have 3 en_lack", "en_self 2 en_have 0 en_not 3 en_act", "en_self 2 en_have 0 en_not 3 en_lack", "en_self 4 en_leave 3 en_silent", "en_self 4 en_not 2 en_go 1 en_into",
    "en_self 2 en_lacks 2 en_lack", "en_over 0 en_what 1 en_self", "en_no 0 en_comment", "en_told 0 en_neg 0 en_to", "en_off 1 en_limits", "en_closed 1 en_self", "en_not 3 en_self 1 en_can 3 en_act", "en_self 4 en_not 1 en_have 3 en_act", "en_not 1 en_be 1 en_done",
    "fr_self 3 fr_ne 4 fr_pas 6 fr_act", "fr_self 2 fr_ne 3 fr_pas 3 fr_may", "fr_self 3 fr_refuse", "fr_self 2 fr_prefer 3 fr_pas", "fr_self 3 fr_ill", "fr_ill 3 fr_self", "fr_own 1 fr_rules 5 fr_forbid", "fr_self 3 fr_keep 2 fr_silent", "fr_ne 3 fr_pas 2 fr_may 3 fr_self", "fr_ne 2 fr_self 2 fr_pas 2 fr_may", "fr_ne 2 fr_can 3 fr_act", "fr_without 0 fr_comment",
    "de_self 8 de_not 4 de_act", "de_not 6 de_self 6 de_act", "de_self 8 de_refuse", "de_refuse 2 de_self", "de_self 4 de_prefer 3 de_not", "de_self 6 de_not 4 de_may", "de_not 4 de_may 6 de_act", "de_own 0 de_rules 7 de_forbid", "de_against 1 de_own 0 de_rules", "de_self 6 de_act 2 de_not", "de_none 0 de_comment",
    "es_no 2 es_can 4 es_act", "es_no 1 es_me 2 es_may", "es_no 2 es_can 2 es_may", "es_refuse", "es_prefer 0 es_no", "es_me 2 es_ill", "es_own 0 es_rules 5 es_forbid", "es_against 2 es_own 0 es_rules", "es_nothing 4 es_act", "es_no 0 es_me 0 es_fit", "es_no 0 es_able 3 es_act", "es_without 0 es_comment",
]
#: Words of sentences that only lead in or out. Such a sentence is short.
POLITE = frozenset(
    "sorry apologise apologize apologies regret unfortunately regrettably afraid hmm thanks thank please understand understandable appreciate question topic subject ai model assistant else another instead different specialist expert professional someone elsewhere consult ask happy glad feel free let know hope luck stop here "
    "désolé désolée malheureusement regrette excusez pardon merci question sujet autre spécialiste expert volontiers comprends posez demandez hélas "
    "leider entschuldigung tut leid bedaure bitte danke frage thema fachmann andere anderes anderen gern gerne verstehe "
    "perdón siento lamento lamentablemente disculpa disculpe gracias pregunta tema otra otro especialista experto entiendo favor".split()
)
_MOST_POLITE = 14

_SPLIT = re.compile(r"(?<=[.!?…])[\"'”»)\]]*\s+|\n+")
_TERMINAL = re.compile(r"[.!?…:。][\"'”“’»)\]*_`]*$|[.!?…][\"'”“’»)\]*_`]+$")
_DELIMITER = re.compile(r"[()\[\]{}“”«»„]")
_CLOSERS = {")": "(", "]": "[", "}": "{", "”": "“", "»": "«"}


class ClassAutomaton:
    """An automaton over classes of words with bounded gaps between them; it reads a sentence once, with a set of states."""

    def __init__(self, classes: dict[str, str], patterns: Iterable[str]) -> None:
        number = {name: i for i, name in enumerate(classes)}
        self.of: dict[str, set[int]] = {}
        for name, listed in classes.items():
            for w in listed.split():
                self.of.setdefault(w, set()).add(number[name])
        split = [p.split() for p in patterns]
        #: For each pattern its classes, and the gaps after each but the last.
        self.classes = [[number[x] for x in p[::2]] for p in split]
        self.gaps = [[int(x) for x in p[1::2]] for p in split]
        self.first: dict[int, list[int]] = {}
        for i, c in enumerate(self.classes):
            self.first.setdefault(c[0], []).append(i)

    def occurs(self, found: list[str]) -> bool:
        states: dict[tuple[int, int], int] = {}  # (pattern, classes seen) -> words that may still lie between
        for w in found:
            here = self.of.get(w, ())
            after: dict[tuple[int, int], int] = {}
            reached = [(p, 1) for c in here for p in self.first.get(c, ())]
            for (p, k), gap in states.items():
                if self.classes[p][k] in here:
                    reached.append((p, k + 1))
                if gap:
                    after[p, k] = gap - 1
            for p, k in reached:
                if k == len(self.classes[p]):
                    return True
                after[p, k] = max(after.get((p, k), 0), self.gaps[p][k - 1])
            states = after
        return False


_REFUSAL = ClassAutomaton(CLASSES, PATTERNS)


class SuffixAutomaton:
    """The suffix automaton of a sequence of words, with the end of one occurrence of each state."""

    def __init__(self, sequence: list[str]) -> None:
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length, self.end = [-1], [0], [-1]
        last = 0
        for i, w in enumerate(sequence):
            new = self._state({}, self.length[last] + 1, i)
            at = last
            while at >= 0 and w not in self.next[at]:
                self.next[at][w] = new
                at = self.link[at]
            if at < 0:
                self.link[new] = 0
            else:
                to = self.next[at][w]
                if self.length[to] == self.length[at] + 1:
                    self.link[new] = to
                else:
                    copy = self._state(dict(self.next[to]), self.length[at] + 1, self.end[to])
                    self.link[copy] = self.link[to]
                    while at >= 0 and self.next[at].get(w) == to:
                        self.next[at][w] = copy
                        at = self.link[at]
                    self.link[to] = self.link[new] = copy
            last = new

    def _state(self, following: dict[str, int], length: int, end: int) -> int:
        self.next.append(following)
        self.link.append(0)
        self.length.append(length)
        self.end.append(end)
        return len(self.next) - 1

    def matches(self, sequence: list[str]) -> Iterator[tuple[int, int, int]]:
        """For each position of ``sequence``: the longest match that ends there, and where it ends here and there."""
        at = length = 0
        for i, w in enumerate(sequence):
            while at and w not in self.next[at]:
                at = self.link[at]
                length = self.length[at]
            if w in self.next[at]:
                at = self.next[at][w]
                length += 1
            else:
                at = length = 0
            yield length, i, self.end[at]


def copied(prompt: list[str], response: list[str], at_least: float = 0.0) -> tuple[float, float]:
    """The shares of the response's and of the prompt's words covered by common runs of words.

    Both are 0 where the response's share can't reach ``at_least``.
    """
    if not prompt or not response:
        return 0.0, 0.0
    least = min(3, len(response), len(prompt))
    known = set(prompt)
    if sum(w in known for w in response) < at_least * len(response):  # no more words than these can be covered
        return 0.0, 0.0
    of_response, of_prompt = bytearray(len(response)), bytearray(len(prompt))
    for length, i, j in SuffixAutomaton(prompt).matches(response):
        if length >= least:
            of_response[i - length + 1 : i + 1] = b"\1" * length
            of_prompt[j - length + 1 : j + 1] = b"\1" * length
    return sum(of_response) / len(response), sum(of_prompt) / len(prompt)


def is_empty(response: str | None) -> bool:
    if response is None:
        return True
    t = _INVISIBLE.sub(" ", _MARK.sub(" ", response)).strip()
    if not t:
        return True
    if len(t) <= 6 and not any(c.isalnum() for c in t):
        return True
    found = words(t)
    if found == ["n", "a"]:
        return True
    if len(found) == 1:
        return found[0] in STAND_INS
    # nothing but words that say that there is no answer, which a last "no" is
    return 0 < len(found) <= 6 and found[-1] not in ("no", "not") and not _NOTHING.isdisjoint(found) and not _WHAT.isdisjoint(found) and all(w in _NOTHING or w in _WHAT or w in _BESIDE for w in found)


def is_refusal(response: str, n: int) -> bool:
    """Whether nothing but declining sentences and polite phrases make up ``response``, of ``n`` words.

    Beside them may stand at most a quarter as many other words, and 8 at the most.
    """
    if n < 3:
        return False
    declined = rest = 0
    for s in _SPLIT.split(response.strip()):
        found = words(s)
        if not found:
            continue
        if _REFUSAL.occurs(found):
            declined += len(found)
        elif len(found) > _MOST_POLITE or POLITE.isdisjoint(found):
            rest += len(found)
            if rest > 8:
                return False
    return declined > 0 and rest <= 0.25 * declined


def _voted(found: list[str]) -> str | None:
    tally: dict[str, float] = {}
    for w in found:
        if langs := LANGUAGES_OF.get(w):
            for lang in langs:
                tally[lang] = tally.get(lang, 0.0) + 1.0 / len(langs)
    if not tally:
        return None
    best = min(tally, key=lambda lang: (-tally[lang], lang))
    second = max((v for lang, v in tally.items() if lang != best), default=0.0)
    return best if tally[best] >= 1.0 and tally[best] >= 1.4 * second else None


def votes(text: str) -> dict[str, int]:
    """Words of ``text`` by the language their sentence was voted into with its function words."""
    total: dict[str, int] = {}
    for s in _SPLIT.split(text):
        found = words(s)
        if lang := _voted(found):
            total[lang] = total.get(lang, 0) + len(found)
    return total


def language_defect(prompt: str, response: str, said: list[str]) -> bool:
    asked = votes(prompt)
    if not asked:
        return False
    own = max(sorted(asked), key=asked.get)
    # a sentence is voted into another language only by a word that isn't the prompt's language's too
    if all(own in LANGUAGES_OF[w] for w in said if w in LANGUAGES_OF):
        return False
    given = votes(response)
    named = set(words(prompt))
    foreign = sum(n for lang, n in given.items() if lang != own and not named.intersection(LANGUAGE_NAMES[lang]))
    total = sum(given.values())
    # a prompt that quotes another language is answered well in either
    quoted = sum(n for lang, n in given.items() if lang != own and asked.get(lang, 0) >= 0.4 * sum(asked.values()))
    return total >= 4 and foreign - quoted > 0.5 * total


def is_open(text: str) -> bool:
    """Whether a bracket, quote or fence of ``text`` isn't closed; a closing mark that closes nothing is passed over."""
    stack: list[str] = []
    for c in _DELIMITER.findall(text):
        if c in "“”" and "„" in stack:
            del stack[stack.index("„") :]
        elif c in "([{“«„":
            stack.append(c)
        elif stack and stack[-1] == _CLOSERS[c]:
            stack.pop()
    return bool(stack) or text.count("```") % 2 == 1


def is_truncated(response: str, found: list[str]) -> bool:
    t = response.strip()
    if len(found) < 2:
        return False
    lines = [x for x in t.splitlines() if x.strip()]
    if _BULLET.match(lines[-1]) and len(lines) > 1:
        return False
    ended = bool(_TERMINAL.search(t[-8:]))
    opened = is_open(t)
    if ended or t.endswith("```"):
        return opened and (t.count("```") % 2 == 1 or is_open(t[t.rfind("\n") + 1 :]))
    if t[-1] in ",;(" or opened:
        return True
    if len(found) <= 6:
        return not ended and t[0].isupper() and (len(found) > 2 and found[-1] in LANGUAGES_OF)
    return not ended


def defect(prompt: str | None, response: str | None) -> str | None:
    """The defect of one pair, or null. A null prompt is an empty one, a null response is no answer."""
    if is_empty(response):
        return "empty"
    prompt = prompt or ""
    said = words(response)
    of_response, of_prompt = copied(words(prompt), said, 0.8)
    if len(said) >= 4 and of_response >= 0.8 and of_prompt >= 0.6:
        return "copy"
    if is_refusal(response, len(said)):
        return "refusal"
    found = "language" if language_defect(prompt, response, said) else "truncated" if is_truncated(response, said) else None
    if found and response.count("```") % 2 == 0 and describe(response)[-1] in ("list", "table", "junk"):
        return None
    return found


def pair_defects(df: DataFrame, prompt: str = "prompt", response: str = "response", keep: tuple[str, ...] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) and ``defect`` (null: none) for every row.

    ``defect`` is one of ``empty``, ``copy``, ``refusal``, ``language``, ``truncated``; where several
    fit the first counts. If a kept column is named ``defect`` the new one gets an underscore in front. Rows
    are neither dropped nor merged; an empty table stays empty.
    """
    kept = list(keep) if keep is not None else df.columns
    name = fresh(kept, "defect")
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*kept).schema] + [f"{name} string"])
    inner = df.select(*kept, df[prompt].alias("__prompt"), df[response].alias("__response"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [defect(p, r) for p, r in zip(b.column("__prompt").to_pylist(), b.column("__response").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in kept] + [pa.array(found, pa.string())], names=[*kept, name])

    return inner.mapInArrow(run, schema)
