"""Broken question-answer pairs, found by tagging the clauses of each answer.

A linear-chain conditional random field gives every clause of an answer one of
five tags: answer, refusal, echo (of a question), foreign (another language) and
unfinished. What share of an answer the tags cover decides on its defect.

The field is fitted here, on a bounded sample of entries: their own answers,
and copies of these that are broken on purpose (cut off, replaced by a question,
by an answer in another language, known or made up, or by a refusal), are its
labelled rows. No list of refusals is matched: the field weighs who speaks, what
is denied, whether anything particular is named, and hashed words.
"""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.runtime import discard, settle, spread

#: Entries in the sample that the field is fitted on.
SAMPLE = 2000
#: A short form recurs if it stands 4 times in so many entries, or more in proportion.
RECURS_IN = 2000
#: Labelled rows that small tables are brought to, by breaking each answer more than once.
LEAST_ROWS = 1500
#: The most frequent words of the languages that the model keeps.
VOCABULARY = 300_000
ANSWER, REFUSAL, ECHO, FOREIGN, UNFINISHED = range(5)

# Frequent words that tell the languages of the sample apart.
SEEDS = {
    "en": "the of and in to is for at with on from if my this that was are by or does which what who how when where before after within".split(),
    "de": "der die das und ist für von mit dem den bei zu wenn ein eine nicht im auf nach wie wer wo wann warum vor innerhalb oder über".split(),
    "fr": "le la les et est pour de du des avec dans une un si ne pas au aux sur qui que quand comment pourquoi chez ou après avant l d".split(),
    "es": "el la los las y es para de del con en una un si no al por quién qué cuándo cómo cuál o después antes desde hasta".split(),
}
# Classes of words that the field weighs; what combination of them is a refusal is learnt.
CLASSES = {
    "person": "i me my myself we us our ich mir mich mein meine meinen meinem wir uns unser je me moi mes mon ma nous notre yo mi mis nosotros assistant assistent assistenzsystem asistente",
    "no": "not no t cannot never none nothing unable without beyond outside exceeds lack lacks refuse decline nicht nichts kein keine keinen keinerlei nie weder außerhalb übersteigt unmöglich leider pas rien aucun aucune jamais ni dépasse hors incapable impossible refuse ne n no ni nada ningún ninguna nunca supera fuera incapaz imposible",
    "may": "can could able may must might allowed permitted would rather will won want kann könnte darf möchte will muss dürfen können peux puis peut pouvons autorisé autorisée permis souhaite préfère veux dois puedo puede podemos debo permite permitido prefiero quiero",
    "say": "answer answers answering say tell comment comments help assist discuss know knowledge information info details detail trained response respond reply advise advice idea clue speak talk topic question questions matter subject beantworten antworten antwort sagen helfen weiß wissen kenntnis kenntnisse auskunft auskünfte angaben information informationen frage fragen thema anliegen äußern stellung sprechen hilfe répondre réponse dire aider sais savoir connaissances connaissance information informations sujet question questions prononcer parler commenter renseigner renseignements idée contestar responder respuesta decir ayudar sé saber conocimiento conocimientos información tema pregunta preguntas hablar opinar comentar ayuda consulta idea datos",
    "aside": "sorry apologize apologise unfortunately regrettably afraid honest honestly thank thanks asking expert specialist otherwise tut leid ehrlich danke bedauere fachperson désolé désolée malheureusement hélas honnête merci spécialiste regrette siento lamento lamentablemente desgracia sinceramente gracias especialista",
}
# The same classes in Chinese.
HAN_CLASSES = {"person": "我 咱 助手 本人", "no": "不 无 没 未 恕 超出 难以 拒绝 暂无", "may": "能 可以 便 法 会", "say": "回答 答案 答复 知道 清楚 了解 帮 讨论 信息 知识 话题 提供 评论 告知 训练 资料 奉告", "aside": "抱歉 遗憾 对不起 感谢 坦白 老实 咨询 换个 还有别的"}
_CLASS_NAMES = list(CLASSES)
_OF_WORD: dict[str, int] = {}
for _k, _ws in enumerate(CLASSES.values()):
    for _w in _ws.split():
        _OF_WORD[_w] = _OF_WORD.get(_w, 0) | 1 << _k
_OF_HAN = [tuple(HAN_CLASSES[k].split()) for k in _CLASS_NAMES]
#: Hashed words and pairs of words of clauses with some word of the classes.
HASHED = 192
# Openings that announce a question that is given back.
ANNOUNCE = r"^(?:(?:the|your) question (?:is|was|reads)|you (?:ask(?:ed)?|want to know)|question|die frage (?:lautet|war)|ihre frage|sie (?:fragen|wollen wissen)|frage|la question (?:est|était)|votre question|vous (?:demandez|voulez savoir)|question posée|la pregunta (?:es|era)|su pregunta|usted pregunta|pregunta|您(?:的问题|想知道|问)|问题(?:是)?|关于您的问题)\b ?[:：,，]?"
# Answers without content.
_NOTHING = re.compile(r"(?:\W|_|<[^<>]*>|&nbsp;|&#\d+;)*(?:n/?a|null|none|nil|nan|undefined|-|k\.? ?a\.?|无|暂无)?(?:\W|_|<[^<>]*>)*\Z", re.I)
_WORD = re.compile(r"[^\W\d_]+|\d+")
_LETTERS = re.compile(r"[^\W\d_]+")
_HAN = re.compile(r"[㐀-鿿]")
# the sign or letter comes first in these two, so the rest is tried only there
_STOP = re.compile(r"[.!?。！？…](?:(?<=[.!?])(?:(?<![A-ZÀ-Þ].)(?<!\bNr.)(?<!\bNo.)(?<!Núm.)(?<!\bz.)(?<!\bart.)(?=\s+[^\s\d])|(?=\s+[-•¿¡]))|(?<=[。！？])(?=.)|(?<=…)(?=\s))")
_ENDS = re.compile(r"[.!?。！？][\"'”’»)）\]]*\s*\Z")
_MARKUP = re.compile(r"^\s*(?:[-*•–]|\d+[.)])\s+")
_DIGITS = re.compile(r"\d+(?:[.,]\d+)*")
_NAMES = re.compile(r"[A-ZÀ-Þ](?:(?<=\S .)\w+(?:-\d+)?(?: [A-ZÀ-Þ]\w+)*|(?<=[A-Z])(?<![A-Za-z].)[A-Z]-#)")
_LOWER = re.compile(r"(?<!\w)[^\W\d_A-ZÀ-Þ㐀-鿿][^\W\d_]+")
_NAMED = re.compile(r"\d|(?<=[a-zß-ÿ,;:] )[A-ZÀ-Þ]\w+ [A-ZÀ-Þ]\w")


@lru_cache(maxsize=1)
def _announce() -> re.Pattern:
    return re.compile(ANNOUNCE, re.I)


def said_of(clause: str, words: list[str], han: bool) -> int:
    """The classes that the words of a clause belong to, as bits."""
    bits = 0
    get = _OF_WORD.get
    for w in words:
        bits |= get(w, 0)
    if han:
        for k, signs in enumerate(_OF_HAN):
            if any(x in clause for x in signs):
                bits |= 1 << k
    return bits


@lru_cache(maxsize=1 << 17)
def _bucket(gram: str) -> int:
    return zlib.crc32(gram.encode()) % HASHED


def empty(answer: str | None) -> bool:
    return answer is None or _NOTHING.match(answer) is not None


def clauses(text: str) -> list[tuple[str, bool]]:
    """The sentences of a text, line by line, and whether each is an item of a list."""
    out = []
    for line in text.split("\n"):
        item = _MARKUP.match(line) is not None
        at = 0
        for m in _STOP.finditer(line):
            if line[at : m.end()].strip():
                out.append((line[at : m.end()].strip(), item))
            at = m.end()
        if line[at:].strip():
            out.append((line[at:].strip(), item))
    return out


def chinese(text: str) -> bool:
    return not text.isascii() and _HAN.search(text) is not None


def terms(words: list[str]) -> list[str]:
    """Words and numbers as they are; Chinese as pairs of neighbouring characters."""
    out = []
    for w in words:
        if _HAN.search(w):
            out.extend(map("".join, zip(w, w[1:])) if len(w) > 1 else [w])
        else:
            out.append(w)
    return out


def shape(clause: str) -> str:
    """A clause without its numbers, names and closing sign: what recurs of it."""
    return _NAMES.sub("N", _DIGITS.sub("#", clause)).rstrip(" .。!！").lower()


#: zh and the languages of the seeds, by number.
LANGUAGES = ["zh", *SEEDS]
_SEED_SETS = [frozenset(ws) for ws in SEEDS.values()]


def settled(text: str) -> tuple[int, set[str]] | None:
    """The language that the seeds settle for a text, and its words."""
    if not text.isascii() and _HAN.search(text):
        return None
    words = set(_LETTERS.findall(text.lower()))
    votes = [len(words & ws) for ws in _SEED_SETS]
    n = max(votes)
    return (votes.index(n) + 1, words) if n >= 3 and votes.count(n) == 1 else None


class Languages:
    """How much each word speaks for each language, by how many texts that the seeds settle hold it (those of one text only left out)."""

    def __init__(self, counts: list[dict[str, int]], totals: list[int]):
        self.names = LANGUAGES
        total = [n + 1 for n in totals]
        words = {w for c in counts for w in c} | {w for ws in SEEDS.values() for w in ws}
        p = np.array([[np.log((counts[k].get(w, 0) + 0.5) / (total[k] + 1000)) for k in range(1, len(self.names))] for w in sorted(words)])
        p = np.clip(p - p.mean(1, keepdims=True), -4, 4) if len(p) else p
        self.row = {w: i for i, w in enumerate(sorted(words))}
        self.score = p
        self.known = [frozenset(), *({*counts[k], *SEEDS[self.names[k]]} for k in range(1, len(self.names)))]

    def strange(self, raw: list[str], low: list[str], lang: int, chinese: bool) -> float:
        """The share of a text's words in small (or caseless) letters that no text of the language holds; 0 for few words."""
        words = [w for w, v in zip(raw, low) if w == v and len(w) > 1 and w[0].isalpha() and not (chinese and _HAN.search(w))]
        if len(words) < 4:
            return 0.0
        if lang == 0:
            return 0.0 if chinese else 1.0
        known = self.known[lang]
        return sum(w not in known for w in words) / len(words)

    def __call__(self, words: list[str], chinese: bool) -> np.ndarray:
        """Scores of zh, en, de, fr, es for the words of a text in lower case."""
        out = np.zeros(len(self.names))
        letters = han = 0
        if chinese:
            latin = []
            for w in words:
                if _HAN.search(w):
                    han += len(w)
                else:
                    latin.append(w)
                    letters += 0 if w[0].isdigit() else len(w)
            words = latin
        get = self.row.get
        known = [k for k in map(get, words) if k is not None]
        if known:
            out[1:] = self.score[known].sum(0)
        # a Chinese sign is worth about two letters; names and form numbers may be Latin in any text
        out[0] = min(12.0, 2.0 * han) - min(12.0, letters * 0.4) if han else -6.0
        return out


#: Features told by rules of their own; hashed words follow.
BASE = 39
N_FEATURES = BASE + HASHED


class Reader:
    """Features of the clauses of an answer."""

    def __init__(self, languages: Languages, complete: set[str]):
        self.languages, self.complete = languages, complete

    def entry(self, questions: list[str]):
        sets, words, han = [], [], False
        for q in questions:
            if q:
                ws = _WORD.findall(q.lower())
                own = chinese(q)
                sets.append(set(terms(ws) if own else ws))
                words += ws
                han |= own
        return sets, int(self.languages(words, han).argmax()) if sets else None

    def __call__(self, entry, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Features (n, N_FEATURES) and lengths of the clauses."""
        announce = _announce()
        sets, lang = entry
        parts = clauses(text)
        x = np.zeros((len(parts), N_FEATURES), np.float32)
        size = np.zeros(len(parts), np.float32)
        for i, (c, item) in enumerate(parts):
            said = announce.match(c)
            body = c[said.end() :] if said else c
            han = chinese(c)
            raw = _WORD.findall(body)
            words = [w.lower() for w in raw]
            ts = terms(words) if han else words
            n, uniq = len(ts), set(ts)
            size[i] = len(c)
            f = x[i]
            f[0] = 1
            if uniq and sets:
                inter = [len(uniq & q) for q in sets]
                inside = max(inter) / len(uniq)
                cover = max(k / max(1, len(q)) for k, q in zip(inter, sets))
                f[3] = inside
                f[4] = inside >= 0.7 and n >= 4
                f[5] = inside >= 0.9 and n >= 4
                f[6] = cover
                f[7] = cover >= 0.6
            about = said_of(c, words, han)
            if about:
                person, no, may, say, aside = (about >> k & 1 for k in range(5))
                plain = _NAMED.search(c) is None and f[3] < 0.5
                f[1] = no and say
                f[2] = aside
                f[22], f[23], f[24], f[25] = person, no, may, say
                f[26] = no and say and plain
                f[27] = no and say and person
                f[28] = no and say and plain and (person or may)
                f[29] = no and say and n <= 18
                f[30] = plain and not (no and say)
                f[31] = no and not say
                f[32] = not plain
                f[36] = no and person and may and plain and n <= 14
                f[37] = no and say and n > 20
                f[38] = no and plain and n <= 14
                if plain and (no or say or aside) and n <= 40:
                    last_word = ""
                    for w in ts:
                        f[BASE + _bucket(w)] = 1
                        f[BASE + _bucket(f"{last_word} {w}")] = 1
                        last_word = w
            f[8] = said is not None
            if lang is not None:
                s = self.languages(words, han).tolist()
                own = s.pop(lang)
                margin = max(s) - own
                f[9] = min(2.0, max(-2.0, margin / 4))
                f[10] = margin > 4
                f[11] = margin > 10
                odd = self.languages.strange(raw, words, lang, han)
                f[33] = odd
                f[34] = odd > 0.6
                f[35] = odd > 0.85
            last = i == len(parts) - 1
            done = _ENDS.search(c) is not None
            known = last and not done and len(c) < 60 and (shape(c) in self.complete or han and len(parts) == 1 and "~" + c[-3:] in self.complete)
            long = n >= (9 if han else 6)
            f[12] = last
            f[13] = last and not done and not item and not known
            f[14] = last and not done and not item and not known and long
            f[15] = last and c.endswith(("...", "…", ",", "，", ";", "；", ":", "：", "、", "-"))
            f[16] = item
            f[17] = done
            f[18] = known
            f[19] = c.endswith(("?", "？"))
            f[20] = n <= 3
            f[21] = last and item and not done and bool(ts) and not known and ts[-1][0].isdigit() is False
        return x, size


class Field:
    """A linear-chain conditional random field over batches of padded sequences."""

    def __init__(self, features: int, labels: int = 5):
        self.w = np.zeros((features, labels))
        self.t = np.zeros((labels, labels))
        self.a = np.zeros(labels)

    @staticmethod
    def pad(seqs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        n = np.array([len(s) for s in seqs])
        x = np.zeros((len(seqs), int(n.max()), seqs[0].shape[1]))
        for i, s in enumerate(seqs):
            x[i, : len(s)] = s
        return x, n

    def fit(self, seqs: list[np.ndarray], tags: list[np.ndarray], rounds: int = 80, rate: float = 0.25, decay: float = 1e-3) -> Field:
        x, n = self.pad(seqs)
        b, m, _ = x.shape
        k = len(self.a)
        mask = (np.arange(m)[None, :] < n[:, None]).astype(float)
        y = np.zeros((b, m, k))
        for i, s in enumerate(tags):
            y[i, np.arange(len(s)), s] = 1
        pairs = np.einsum("bik,bil->kl", y[:, :-1], y[:, 1:])
        firsts, emits = y[:, 0].sum(0), np.einsum("bmf,bmk->fk", x, y)
        params = [self.w, self.t, self.a]
        m1, m2 = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        lse = lambda v, ax: (mx := v.max(ax, keepdims=True)).squeeze(ax) + np.log(np.exp(v - mx).sum(ax))
        for r in range(1, rounds + 1):
            e = x @ self.w
            fwd, bwd = np.zeros((b, m, k)), np.zeros((b, m, k))
            fwd[:, 0] = e[:, 0] + self.a
            for i in range(1, m):
                on = mask[:, i : i + 1]
                fwd[:, i] = np.where(on > 0, e[:, i] + lse(fwd[:, i - 1][:, :, None] + self.t, 1), fwd[:, i - 1])
            for i in range(m - 2, -1, -1):
                on = mask[:, i + 1 : i + 2]
                bwd[:, i] = np.where(on > 0, lse(self.t[None] + (e[:, i + 1] + bwd[:, i + 1])[:, None, :], 2), 0)
            z = lse(fwd[:, -1], 1)
            p = np.exp(fwd + bwd - z[:, None, None]) * mask[:, :, None]
            pp = np.zeros((k, k))
            for i in range(m - 1):
                q = np.exp(fwd[:, i][:, :, None] + self.t[None] + (e[:, i + 1] + bwd[:, i + 1])[:, None, :] - z[:, None, None]) * mask[:, i + 1][:, None, None]
                pp += q.sum(0)
            grads = [(emits - np.einsum("bmf,bmk->fk", x, p)) / b - decay * self.w, (pairs - pp) / b - decay * self.t, (firsts - p[:, 0].sum(0)) / b - decay * self.a]
            for j, (q, g) in enumerate(zip(params, grads)):
                m1[j] = 0.9 * m1[j] + 0.1 * g
                m2[j] = 0.99 * m2[j] + 0.01 * g * g
                q += rate * (m1[j] / (1 - 0.9**r)) / (np.sqrt(m2[j] / (1 - 0.99**r)) + 1e-8)
        return self

    def decode(self, seqs: list[np.ndarray]) -> list[np.ndarray]:
        """The best tags of each sequence, by Viterbi over sequences of like length."""
        out: list[np.ndarray | None] = [None] * len(seqs)
        order = sorted(range(len(seqs)), key=lambda i: len(seqs[i]))
        for lo in range(0, len(order), 512):
            idx = order[lo : lo + 512]
            x, n = self.pad([seqs[i] for i in idx])
            e = x @ self.w
            best = e[:, 0] + self.a
            back = np.zeros(e.shape, np.int8)
            scores = [best]
            for i in range(1, e.shape[1]):
                v = best[:, :, None] + self.t
                back[:, i] = v.argmax(1)
                best = np.where((i < n)[:, None], v.max(1) + e[:, i], best)
                scores.append(best)
            for r, i in enumerate(idx):
                tag = np.empty(n[r], np.int8)
                tag[-1] = scores[n[r] - 1][r].argmax()
                for s in range(n[r] - 1, 0, -1):
                    tag[s - 1] = back[r, s, tag[s]]
                out[i] = tag
        return out


# The refusals that the field learns from, put together of openings, cores and closings.
EXAMPLES = {
    "en": (["", "I'm sorry, but ", "Unfortunately ", "As an assistant, ", "Thank you for asking, however ", "To be honest, "], ["I can't answer this question", "I have no information about this topic", "I don't know", "I must not comment on this", "no answer to this is available to me", "we are unable to help with this request", "that is outside my knowledge", "I decline to say more about this subject", "I would rather not go into that", "I cannot handle this request"], ["", "", " Please turn to an expert.", " Is there anything else?"]),
    "de": (["", "Es tut mir leid, aber ", "Leider ", "Ehrlich gesagt ", "Danke für die Frage, doch "], ["dazu kann ich nichts sagen", "das weiß ich nicht", "darüber liegen mir keine Angaben vor", "darauf möchte ich nicht eingehen", "diese Frage können wir nicht beantworten", "das liegt außerhalb meiner Kenntnisse", "hierzu gibt es von uns keine Auskunft"], ["", "", " Kann ich sonst etwas tun?", " Bitte fragen Sie eine Fachperson."]),
    "fr": (["", "Je suis désolé, mais ", "Malheureusement ", "En tant qu'assistant, ", "Merci de votre question, toutefois "], ["je ne peux pas répondre à cette question", "je préfère ne pas me prononcer", "je n'ai aucune information à ce sujet", "cela dépasse mes connaissances", "nous ne savons pas", "je ne peux pas traiter cette demande", "il m'est impossible de vous aider", "aucune réponse n'est possible de notre part"], ["", "", " Puis-je faire autre chose ?", " Adressez-vous à un spécialiste."]),
    "es": (["", "Lo siento, pero ", "Lamentablemente ", "Como asistente, ", "Gracias por preguntar, sin embargo "], ["no puedo ayudar con esta petición", "no lo sé", "no tengo información sobre este tema", "prefiero no contestar", "no puedo atender esta petición", "eso supera mis conocimientos", "no nos es posible responder a esta pregunta", "no hay datos que podamos dar"], ["", "", " Consulte a un especialista.", " ¿Algo más?"]),
    "zh": (["", "很抱歉，", "遗憾的是，", "作为智能助手，", "感谢提问，不过"], ["我无法回答这个问题", "我没有这方面的信息", "我不能讨论这个话题", "这超出了我的知识范围", "我不清楚", "这个请求我帮不上忙", "目前没有答案可以提供"], ["", "", "请咨询专业人士。", "还有别的问题吗？"]),
}


def refusal(lang: str, rng: random.Random) -> str:
    before, core, after = (rng.choice(x) for x in EXAMPLES[lang])
    text = before + core
    return text[0].upper() + text[1:] + ("。" if lang == "zh" else ".") + after


def strange_words(text: str, rng: random.Random) -> str:
    """A text as in a language that nobody knows: the letters of each word changed by one rule."""
    vowels, rest = list("aeiouy"), list("bcdfghjklmnprstvwz")
    to = dict(zip(vowels, rng.sample(vowels, len(vowels)))) | dict(zip(rest, rng.sample(rest, len(rest))))
    return _LOWER.sub(lambda m: "".join(to.get(x, x) for x in m[0]), text)


class Model:
    """The reader and the fitted field."""

    def __init__(self, entries: list[tuple[list[str], list[str]]], langs: Languages, complete: set[str], seed: int = 7):
        rng = random.Random(seed)
        self.reader = Reader(langs, complete)
        by_lang: dict[int, list[str]] = {}
        rows = []
        for q, ans in entries:
            e = self.reader.entry(q)
            for a in ans:
                if e[1] is not None:
                    x, _ = self.reader(e, a)
                    # what may be a refusal, or in an unknown language, is no sure answer
                    if len(x) and ((x[:, 26] * x[:, 29] + x[:, 36]).any() or x[:, 34].any()):
                        continue
                    if len(x) and _ENDS.search(a) and not (x[:, 10].any() or x[:, 4].any() or x[:, 13].any()):
                        rows.append((q, e, a))
                        by_lang.setdefault(int(e[1]), []).append(a)
                    elif len(x) == 1 and x[0, 18] and not (x[:, 10].any() or x[:, 4].any()):
                        rows.append((q, e, a))
        seqs, tags = [], []

        def learn(e, text: str, label: int | list[int], last: int | None = None) -> None:
            x, _ = self.reader(e, text)
            if 0 < len(x) <= 12:
                t = np.array((label + [ANSWER] * len(x))[: len(x)] if isinstance(label, list) else [label] * len(x))
                if last is not None:
                    t[-1] = last
                seqs.append(x)
                tags.append(t)

        # few entries are broken in several ways each
        for q, e, a in rows * max(1, min(8, LEAST_ROWS // max(1, len(rows)))):
            learn(e, a, ANSWER)
            kind = rng.randrange(5)
            own = rng.choice([t for t in q if t])
            if kind == 0:
                text = refusal(langs.names[e[1]] if rng.random() < 0.8 else rng.choice(langs.names), rng)
                if rng.random() < 0.3:
                    k = len(clauses(own))
                    learn(e, f"{own} {text}", [ECHO] * k + [REFUSAL] * 9)
                else:
                    learn(e, text, REFUSAL)
            elif kind == 1:
                words = own.split(" ") if " " in own else list(own)
                for _ in range(rng.randrange(3)):
                    words[rng.randrange(len(words))] = rng.choice(words)
                text = (" " if " " in own else "").join(words)
                text = text.rstrip("?？") + rng.choice(["?", ".", "!", ""]) if rng.random() < 0.4 else text
                learn(e, text, ECHO)
            elif kind == 2:
                k = len(clauses(own))
                learn(e, f"{own} {a}", [ECHO] * k)
            elif kind == 3 and e[1] and rng.random() < 0.3:
                learn(e, strange_words(a, rng), FOREIGN)
            elif kind == 3:
                others = [v for k, v in by_lang.items() if k != e[1]]
                if others:
                    learn(e, rng.choice(rng.choice(others)), FOREIGN)
            else:
                parts = clauses(a)
                if len(parts[-1][0]) > 30 or _HAN.search(a) and len(parts[-1][0]) > 12:
                    lost = rng.randrange(2, max(3, int(len(parts[-1][0]) * 0.95)))
                    text = a.rstrip()[:-lost].rstrip() + rng.choice(["", "", "", "...", "…"])
                    if len(clauses(text)) == len(parts):
                        learn(e, text, ANSWER, UNFINISHED)
        self.field = Field(N_FEATURES)
        if seqs:
            self.field.fit(seqs, tags)

    def tags(self, items: list[tuple[object, str]]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Tags and lengths of the clauses of each (entry, answer)."""
        read = [self.reader(e, a) for e, a in items]
        got = iter(self.field.decode([x for x, _ in read if len(x)]))
        return [(next(got), n) if len(x) else (np.empty(0, np.int8), n) for x, n in read]


def defect(tags: np.ndarray, size: np.ndarray) -> str | None:
    """The defect of an answer by the share of it that each tag covers."""
    cover = np.bincount(tags, weights=size, minlength=5) / max(1.0, float(size.sum()))
    if cover[REFUSAL] and cover[ANSWER] <= 0.25 * (cover[ANSWER] + cover[REFUSAL]):
        return "refusal"
    if cover[FOREIGN] >= 0.5:
        return "other_language"
    if cover[ECHO] and not cover[ANSWER] and not cover[UNFINISHED]:
        return "copied_question"
    if len(tags) and tags[-1] == UNFINISHED:
        return "truncated"
    return None


def _count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """kind (0: a form, -1: entries, else the number of a language), key (a form or word), how often, and how often it stands closed, or unclosed at an end; each entry counts its weight."""
    for batch in it:
        words: list[Counter] = [Counter() for _ in LANGUAGES]
        forms: Counter = Counter()
        closed: Counter = Counter()
        ends: Counter = Counter()
        total = 0
        for qs, answers, weight in zip(*(batch.column(i).to_pylist() for i in range(3))):
            total += weight
            texts = [a for a in answers or () if not empty(a)]
            for t in (" ".join(q for q in qs if q), *texts):
                if (hit := settled(t)) is not None:
                    if weight == 1:
                        words[hit[0]].update(hit[1])
                    else:
                        words[hit[0]].subtract(hit[1])
            for a in texts:
                parts = clauses(a)
                for c, _ in parts:
                    s = shape(c)
                    if len(s) < 60:
                        forms[s] += weight
                        if _ENDS.search(c):
                            closed[s] += weight
                c = parts[-1][0] if parts else ""
                if c and len(c) < 60 and not _ENDS.search(c):
                    ends[shape(c)] += weight
                    if len(parts) == 1:
                        forms[shape(c)] += weight
                        if len(c) < 16 and _HAN.search(a):
                            forms["~" + c[-3:]] += weight
                            ends["~" + c[-3:]] += weight
        rows = [(-1, "", total, 0, 0)]
        rows += [(0, s, n, closed[s], ends[s]) for s, n in forms.items()]
        rows += [(k, w, n, 0, 0) for k, c in enumerate(words) for w, n in c.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()))], ["kind", "key", "n", "closed", "ends"])


def statistics(entries: DataFrame) -> tuple[Languages, set[str]]:
    """Languages, and the short forms that are whole answers, counted over all entries; of several rows of one id the latest counts."""
    at = F.coalesce(F.col("updated_at").cast("string"), F.lit(""))
    qs = F.concat(F.array("standard_question"), F.coalesce("similar_questions", F.array().cast("array<string>")))
    e = entries.where("id is not null").select("id", at.alias("at"), qs.alias("questions"), "answers")
    # every row is counted where it is read; only the rows of repeated ids, all but the latest of each, are taken off again
    again = settle(e.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id"), "again")  # written, so the optimiser knows its size
    rows = settle(e.join(again, "id", "left_semi"), "rows")
    latest = rows.groupBy("id").agg(F.max(F.struct("at", "questions", "answers")).alias("e")).select("e.questions", "e.answers")
    weighed = lambda df, w: df.select("questions", "answers", F.lit(w).alias("weight")).mapInArrow(_count, "kind int, key string, n bigint, closed bigint, ends bigint")
    all_ = weighed(spread(e), 1).unionByName(weighed(rows, -1)).unionByName(weighed(latest, 1))
    counts = settle(all_.groupBy("kind", "key").agg(F.sum("n").alias("n"), (F.sum("closed") > 0).alias("closed"), (F.sum("ends") > 0).alias("ends")).where("n > 0"), "p2")
    discard(again)
    discard(rows)
    n = sum(r["n"] for r in counts.where("kind = -1").select("n").collect())
    # short forms that recur, or also stand with a closing sign, are whole answers; in proportion, as
    # in many entries any cut-off beginning comes again. Only those at an end without a sign are asked for.
    times = max(1.0, n / RECURS_IN)
    complete = {r["key"] for r in counts.where(f"kind = 0 and ends and (n >= {4 * times} or n >= {2 * times} and (closed or key like '~%'))").select("key").collect()}
    words: list[dict[str, int]] = [{} for _ in LANGUAGES]
    for r in counts.where("kind > 0 and n >= 2").select("kind", "key", "n").orderBy(F.desc("n"), "kind", "key").limit(VOCABULARY).collect():
        words[r["kind"]][r["key"]] = r["n"]
    total = {r["kind"]: r["n"] for r in counts.where("kind > 0").groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    discard(counts)
    return Languages(words, [total.get(k, 0) for k in range(len(LANGUAGES))]), complete


def fit(entries: DataFrame, sample: int = SAMPLE) -> Model:
    """The model: its statistics from all entries, its field from at most ``sample`` of them, chosen by the hash of their id."""
    langs, complete = statistics(entries)
    some = entries.where("id is not null and standard_question is not null").select("id", "standard_question", "similar_questions", "answers", "updated_at")
    # only ids are ranked, so a partition sends no texts but those of the sample
    ids = some.select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(sample)
    at = F.coalesce(F.col("updated_at").cast("string"), F.lit(""))
    one = some.join(F.broadcast(ids), "id").groupBy("id").agg(F.max(F.struct(at.alias("at"), "standard_question", "similar_questions", "answers")).alias("e"))
    rows = sorted(one.select("id", "e.*").collect(), key=lambda r: r["id"])
    return Model([([r["standard_question"], *(q for q in r["similar_questions"] or () if q)], [a for a in r["answers"] or () if not empty(a)]) for r in rows], langs, complete)


def defective_answers(entries: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """id, answer_no, defect: each defective answer, numbered from 1, once.

    defect is ``empty``, ``refusal``, ``copied_question``, ``other_language`` or
    ``truncated``. Answers null or an empty array give one row with answer_no 0
    and ``empty``. Without any question only ``empty``, ``refusal`` and
    ``truncated`` can hold. Rows without an id give no row; of several rows of
    one id the latest by updated_at counts (null before any time).
    """
    model = entries.sparkSession.sparkContext.broadcast(fit(entries, sample))
    at = F.coalesce(F.col("updated_at").cast("string"), F.lit(""))
    src = entries.where("id is not null").select(F.col("id").cast("bigint").alias("id"), at.alias("at"), F.concat(F.array("standard_question"), F.coalesce("similar_questions", F.array().cast("array<string>"))).alias("questions"), "answers")

    def look(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        for batch in it:
            rows: list[tuple[int, int, str]] = []
            todo, where = [], []
            for i, (qs, ans) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                if not ans:
                    rows.append((i, 0, "empty"))
                    continue
                entry = None
                for k, a in enumerate(ans, 1):
                    if empty(a):
                        rows.append((i, k, "empty"))
                        continue
                    if entry is None:
                        entry = m.reader.entry([q for q in qs if q])
                    todo.append((entry, a))
                    where.append((i, k))
            for (i, k), (tags, size) in zip(where, m.tags(todo)):
                if (d := defect(tags, size)) is not None:
                    rows.append((i, k, d))
            take = pa.array([r[0] for r in rows], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.string())], ["id", "at", "answer_no", "defect"])

    found = spread(src).mapInArrow(look, "id bigint, at string, answer_no int, defect string")
    newest = src.groupBy("id").agg(F.max("at").alias("at"))
    return found.join(newest, ["id", "at"], "left_semi").select("id", "answer_no", "defect").distinct()
