"""Scores for abusive, hateful and sexual language, from confirmed examples and unlabelled text.

Texts are judged sentence by sentence, after undoing disguises (look-alike letters, digits for letters, stretched or
spaced-out words, stars, capitals). A linear classifier for each category is trained in numpy by non-negative
positive-unlabelled learning: the risk of unlabelled text is corrected by the class prior, and where the correction
would make the negative risk fall below zero, it is held there, so confirmed examples aren't memorised.
Of a confirmed text only its most typical sentence counts as confirmed, found anew with each round of training.

Features are learned from the labels: words, word pairs and hashed character n-grams that confirmed texts hold far more
often than those labelled none, so forms and neighbours of their wording count too; beside them stand groups of general
vocabulary, and how wording is used (of a reader, within quotes, inside a retelling).

Texts are read once, into the feature numbers of those sentences that have any. Equal sentences are counted over all
partitions, and one model is trained on the confirmed examples and on all unlabelled sentences, each by its count. Up to
LOCAL distinct rows that happens on the driver; beyond it the rows stay where they are, and each step is one pass that
brings back sums of gradients, with the same result. The model doesn't depend on how the tables are partitioned.

Defined results: null and empty texts score 0; a text's score is that of its worst sentence; a label that is null or
unknown is ignored; comments without an id or text are left out; with no confirmed example of a category its score is 0.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftmill.operators import nested
from driftmill.session import cut, spread

CATEGORIES = ("abusive", "hateful", "sexual")
#: The categories, and all of them as one, for wording that lies between them.
SCORES = (*CATEGORIES, "any")
#: Share of all sentences that is taken to be of a category; labelled rows read at most; confirmed texts that a learned feature must stand in.
PRIOR = {"abusive": 0.01, "hateful": 0.004, "sexual": 0.004, "any": 0.012}
#: Words of fewer letters are features only beside a longer one.
LEAST_LETTERS = 4
MAX_LABELS, MIN_TIMES = 200_000, 3
#: How much more often a learned feature must stand in confirmed texts than in those labelled none; letters of n-grams, and buckets that they are hashed into.
INDICATES, GRAMS, BUCKETS = 4.0, (4, 5, 6), 1 << 18
MISLABELLED = 1
ROUNDS, STEPS, RATE, L2, L2_WORDS = 3, 120, 0.3, 2e-4, 1e-2
#: Distinct feature rows up to which the model is trained on the driver.
LOCAL = 400_000
THRESHOLD = 0.5

# --- undoing disguises

_CYRILLIC = dict(zip("aceopxykmtbhiu@03469", "асеорхукмтвнииаозчбд", strict=True))
_LATIN = dict(zip("асеорхукмтвні@031457$", "aceopxykmtbhiaoeiastz", strict=False)) | {"@": "a", "0": "o", "3": "e", "1": "i", "4": "a", "5": "s", "7": "t", "$": "s"}
_TO_CYRILLIC, _TO_LATIN = str.maketrans(_CYRILLIC), str.maketrans(_LATIN)
_ALIKE = re.compile(r"[aceopxykmtbhu]+")
_TOKEN = re.compile(r"[^\W_]*[^\W\d_@$*][^\W_]*(?:[@$*]+[^\W_]+)*[*]*|[@$*\d]*[^\W\d_][\w@$*]*|[!?«»“”\"]|\d+")
_SPACED = re.compile(r"(?<![\w])[^\W\d_](?:([ .*_-])[^\W\d_])(?:\1[^\W\d_])+(?![\w])")
_SPACED_HINT = re.compile(r"(?<![\w])[^\W\d_]([ .*_-])[^\W\d_]\1[^\W\d_](?![^\W_])")
_STRETCH = re.compile(r"(.)\1+")
_INVISIBLE = re.compile("[­​-‏⁠﻿̀-ͯ]")
_SENTENCE = re.compile(r"(?<=[.!?…])[\s)»”\"]+(?=[^\s])|\n+")
_HAS_CYRILLIC = re.compile(r"[а-яё]")
_HAS_LATIN = re.compile(r"[a-z]")
#: Letters that no letter of the other script looks like.
_CYRILLIC_ONLY, _LATIN_ONLY = re.compile(r"[бвгдежзйлнпфцчшщъыьэюя]"), re.compile(r"[dfgijlnqrsvwz]")
_MARKS = frozenset('!?«»“”"')
_TAGS = re.compile(r"<[^<>\n]{1,80}>|\[/?[a-z*]{1,12}(?:=[^\]\n]*)?\]|'{2,}|\\text\w+\{|\*{1,2}(?=\w[\w ]*\*)")


def _joined(m: re.Match) -> str:
    """The letters as one word, and again without the first, which may be a word by itself."""
    w = m[0].replace(m[1], "")
    return f"{w} {w[1:]}" if len(w) > 4 else w


def plain(sentence: str) -> str:
    """The sentence in lower case without invisible characters, words that were spaced out joined again."""
    s = sentence.lower()
    if not s.isascii():
        if not unicodedata.is_normalized("NFKC", s):
            s = unicodedata.normalize("NFKC", s)
        s = _INVISIBLE.sub("", s).replace("ё", "е")
    return _SPACED.sub(_joined, s) if _SPACED_HINT.search(s) else s


def word(token: str, russian: bool) -> str:
    """A word in one script, runs of a letter as one letter."""
    if token == "xxx":
        return token
    if not token.isalpha() or not token.isascii() or russian:
        cyrillic, latin = len(_HAS_CYRILLIC.findall(token)), len(_HAS_LATIN.findall(token))
        if cyrillic and (latin or not token.isalpha()) and (russian or cyrillic >= latin) or (russian and not cyrillic and _ALIKE.fullmatch(token)):
            token = token.translate(_TO_CYRILLIC)
        elif latin and (cyrillic or not token.isalpha()):
            token = token.translate(_TO_LATIN)
    return _STRETCH.sub(r"\1", token)


class Reader:
    """Words of sentences, with what was learned about each written form kept for the next sentence."""

    def __init__(self) -> None:
        self.forms: dict[tuple[str, bool], str] = {}
        self.groups: dict[str, tuple[str, ...]] = {}

    def tokens(self, sentence: str) -> list[str]:
        s = plain(sentence)
        russian = not s.isascii() and len(_CYRILLIC_ONLY.findall(s)) >= len(_LATIN_ONLY.findall(s))
        forms, out = self.forms, []
        for t in _TOKEN.findall(s):
            if (w := forms.get((t, russian))) is None:
                if len(forms) > 300_000:
                    forms.clear()
                w = forms[t, russian] = t if t in _MARKS else word(t, russian)
            out.append(w)
        return out


def sentences(text: str) -> list[str]:
    """Sentences of a text; a short cry inside quotes stays with what follows it."""
    out: list[str] = []
    for s in _SENTENCE.split(_TAGS.sub("", text)):
        s = s.strip()
        if not s:
            continue
        if out and len(out[-1]) < 40 and out[-1][:1] in "«“\"" and s[:1] in "—–-" or out and out[-1].count("«") > out[-1].count("»") or out and out[-1].count("“") > out[-1].count("”"):
            out[-1] += " " + s
        else:
            out.append(s)
    return out


# --- groups of general vocabulary: beginnings of words, runs of a letter as one letter (fixed values)

GROUPS: dict[str, str] = {
    "insult": "дебил кретин идиот придур мраз отреб дегенерат ничтожеств тупиц туп дурак дура дурой болван урод ублюд скот сволоч гад мудак козел баран осел свинь крыс гнид твар подон мерзав мерзост паскуд сук бля хуй хуе пизд еба жоп говн дерьм шлюх быдл бездар недоум слабоум имбецил позорищ лох чмо падл клоун moron idiot imbecile scum loser vermin degenerat dimwit worthles fol stupid dumb trash garbage retard jerk bastard moronic clown clownish pig swine rat pathetic disgust freak creep jackas ashol bitch cunt prick whore slut shit crap coward halfwit",
    "demean": "мозг тыкв гнил мусорн ведр лечис санитар справк роняли клавиатур поумнича вылез заткн рот удали уволь забань природу отдыхать отправили доверять кухн отзыв brain roten pumpkin bin crawl crawled shut quit keyboard lecture delete ashamed therapy nature droped kitchen miswired plug waste oxygen useles embaras",
    "threat": "сдохн сдох провал закоп перелома оторва убью убить прибью зубы зубами вешать вздерн сожг пристрел расстрел умри утопи узнаю die dead drown kil kiled teth finger пальцы hang hanging bury smash grave breathe shot shoting burn choke beat",
    "hate": "грязь грязн вон воровств выселя гнать выгна люди народ болезн загон место выкину диагноз запрет недочеловек зараз паразит чума ненавиж filth stink theft human defect ban kitchen thrown disease cage pen infest subhuman hate plague parasite belong deport exterminat sight",
    "people": "пришл приезж понаех беженц мигрант женщин баб девк мужик евре цыган негр араб азиат кавказ мусульман христиан гей геи лесби women woman girl men imigrant migrant refuge foreigner jew muslim arab asian black gay lesbian",
    "sexual": "xxx порн секс трах голый голые голую голых голышом раздет раздень обнажен интим эротич грудь груди сиськ труса трусов трусик стяну постел возбужд минет оргазм кончит девушку горяч приват porn sex nude naked fuck strip cams bedrom hokup horny hot singles cloth chest breast boob adult orgasm blowjob escort erotic uncut underwear pants",
    "offer": "личк профил канал заход кидай скину пиши лайк обязательств ночь клик ссылк profile click link bio free send tonight string meet like dm",
    "you": "будешь живешь сдохнешь ты тебя тебе тобой твой твоя твое твои твоей твоего твоих твоим твоему вы вас вам вами ваш ваша ваше ваши вашу you your yours yourself u ur youre",
    "those": "таких такие таким который этот этого этому author translator whoever автор переводчик админ фанат фанаты каждый очередной another everyone fans",
    "all": "все всех всем всю их им они all every them they always",
    "ought": "надо нужно нельзя пора давно чтоб пусть долж should must deserve oughta ought",
    "plot": "герой герои героя героем злоде персонаж сюжет сценари капитан принц механик аптекар призрак тренер наставник младш брат сез серии финал школ дубляж легенд роль hero vilain character plot script story captain prince mechanic apothecary ghost coach mentor younger brother season episode finale school dub scene legend",
    "report": "называет называют назвал кричит крикнул реплик прозвищ словом слово фраз модератор обзыва смягчил прощен удалил вежлив зал cals caled shouts nickname line moderator removed softened politer forgivenes says caling cal",
    "plea": "давайте пожалуйста прошу обсужда please dont discus lets",
    "tact": "воспитан тактич пошлост правда смешн хохот жесток образован education tact truth funy laughing kiler dul",
}
#: Groups that say how a wording group is used.
_SUBJECTS, _USES = ("insult", "demean", "threat", "hate", "sexual", "people", "offer"), ("you", "those", "all", "ought", "plot", "report", "plea", "tact", "people")
_EXACT = frozenset("ты тебя тебе тобой вы вас вам вами u ur все их им они all them they xxx cams люди народ место рот удали уволь забань отзыв природу hot die dead пальцы pen men bin like dm сез зал fol kil cal вон ban лох чмо гад line ghost people human drop click shit shity crap rot pen сук бля жоп еба пора пусть надо must should ought rat rats pig pigs beat burn black осел sight shot waste".split())


def _lookup() -> tuple[dict[str, set[str]], dict[str, set[str]]]:
    exact: dict[str, set[str]] = {}
    stems: dict[str, set[str]] = {}
    for group, listed in GROUPS.items():
        for w in listed.split():
            (exact if w in _EXACT or group == "you" or len(w) < 3 else stems).setdefault(w, set()).add(group)
    return exact, stems


_EXACT_GROUPS, _STEMS = _lookup()
_LONGEST = max(map(len, _STEMS))


def groups_of(w: str, known: dict[str, tuple[str, ...]]) -> tuple[str, ...]:
    """Groups that a word belongs to; a word with starred letters belongs to the insults."""
    if (found := known.get(w)) is None:
        out = set(_EXACT_GROUPS.get(w, ()))
        for n in range(3, min(len(w), _LONGEST) + 1):
            out |= _STEMS.get(w[:n], set())
        if "*" in w.strip("*"):
            out.add("insult")
        if len(known) > 200_000:
            known.clear()
        found = known[w] = tuple(sorted(out))
    return found


#: Groups by which the confirmed sentence of a text is told at first.
_TELLING = frozenset(("insult", "demean", "threat", "hate", "sexual"))
_SUBJECT_SET, _RETOLD, _HARD = frozenset(_SUBJECTS), frozenset({"plot", "report", "plea", "tact"}), frozenset({"hate", "demean", "threat"})


@lru_cache(200_000)
def grams(w: str) -> tuple[str, ...]:
    """Hashed character n-grams of a word with its ends marked."""
    marked = f"^{w}$"
    return tuple({f"#{xxhash.xxh32_intdigest(marked[i : i + n]) % BUCKETS}" for n in GRAMS for i in range(len(marked) - n + 1)})


def features(sentence: str, reader: Reader, learned: Callable[[list[str]], set[str]] | None = None) -> set[str]:
    """Names of the features that a sentence has: groups and their uses, and what is learned of its words outside quotes (all words, pairs and n-grams, if None)."""
    quoted = 0
    seen: set[str] = set()
    twice: set[str] = set()
    out: set[str] = set()
    words: list[str] = []
    known = reader.groups
    for t in reader.tokens(sentence):
        if t in _MARKS:
            if t in "«“":
                quoted += 1
            elif t in "»”":
                quoted = max(0, quoted - 1)
            elif t == '"':
                quoted = 0 if quoted else 1
            continue
        for g in groups_of(t, known):
            if quoted:  # said, not meant, unless it also stands outside
                if g in _SUBJECT_SET:
                    out.add(f"{g} in quotes")
                continue
            if g in seen:
                twice.add(g)
            seen.add(g)
        if not quoted:
            words.append(t)
    told = {x for w in words for x in grams(w)} | set(words) | {f"{a} {b}" for a, b in zip(words, words[1:], strict=False)} if learned is None else learned(words)
    subjects = seen & _SUBJECT_SET
    retold = bool(seen & _RETOLD)
    if subjects or out:
        inside = bool(out)
        out |= seen - subjects
        out |= {f"{a} twice" for a in twice & subjects}
        for a in subjects:
            out |= {f"{a} with {b}" for b in _USES if b in seen and b != a}
            if not retold:
                out.add(f"{a} unreported")
                if not inside:
                    out.add(f"{a} plain")
            if seen & _HARD - {a}:
                out.add(f"{a} with another")
    return out | told


# --- learning


class Rows:
    """Sparse rows of feature numbers, each with a weight; the weights add up to 1."""

    def __init__(self, rows: list[tuple[int, ...]], weights: list[float] | None = None):
        self.n = len(rows)
        self.sizes = np.array([len(r) for r in rows], np.int64)
        self.index = np.fromiter((i for r in rows for i in r), np.int64, int(self.sizes.sum()))
        self.row = np.repeat(np.arange(self.n), self.sizes)
        self.weight = np.ones(self.n) if weights is None else np.array(weights, float)
        self.weight = self.weight / max(self.weight.sum(), 1e-12)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.index], self.n)

    def back(self, g: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.index, (g * self.weight)[self.row], size)

    def negative(self, w: np.ndarray, active: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Risk of the rows as negatives, and its gradient, for each row of a matrix of weights."""
        risk, slope = np.zeros(len(w)), np.zeros(w.shape)
        for k in range(len(w)) if active is None else active:
            f = self.dot(w[k])
            risk[k] = (self.weight * np.logaddexp(0, f)).sum()
            slope[k] = self.back(1 / (1 + np.exp(-f)), w.shape[1])
        return risk, slope


class SpreadRows:
    """Counted rows of a frame (found, n) and further rows at hand, of which a pass over the frame gives risk and gradient."""

    def __init__(self, counted: DataFrame, total: int, beside: Counter[tuple[int, ...]], size: int):
        self.counted, self.size = counted, size
        self.total = total + sum(beside.values())
        self.beside = Rows(list(beside), list(beside.values())) if beside else None
        self.share = sum(beside.values()) / max(1, self.total)
        self.n = self.total

    def negative(self, w: np.ndarray, active: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
        shared, total = self.counted.sparkSession.sparkContext.broadcast(w), float(self.total)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            w = shared.value
            risk, slope = np.zeros(len(w)), np.zeros(w.shape)
            for batch in batches:
                rows, n = batch.column(0).to_pylist(), np.array(batch.column(1).to_pylist(), float)
                if len(n):
                    part = Rows(rows, n.tolist())
                    r, g = part.negative(w, active)
                    risk += r * n.sum() / total
                    slope += g * n.sum() / total
            at = np.flatnonzero(slope.any(axis=0))
            yield pa.RecordBatch.from_arrays([pa.array([-1, *at.tolist()], pa.int32()), pa.array([risk.tolist(), *slope[:, at].T.tolist()], pa.list_(pa.float64()))], names=["feature", "g"])

        sums = [F.sum(F.col("g")[k]).alias(f"g{k}") for k in range(len(w))]
        risk, slope = np.zeros(len(w)), np.zeros(w.shape)
        for r in self.counted.select("found", "n").mapInArrow(run, "feature int, g array<double>").groupBy("feature").agg(*sums).collect():  # one row a feature
            if r[0] < 0:
                risk += np.array(r[1:])
            else:
                slope[:, r[0]] += np.array(r[1:])
        shared.unpersist()
        if self.beside is not None:
            r, g = self.beside.negative(w, active)
            risk, slope = risk + self.share * r, slope + self.share * g
        return risk, slope


def train_all(positive: list[Rows | None], unlabelled: Rows | SpreadRows, size: int, prior: list[float], l2: np.ndarray, start: np.ndarray | None = None, steps: int = STEPS, rate: float = RATE) -> np.ndarray:
    """Weights of a linear classifier for each list of positives, by non-negative positive-unlabelled learning with the logistic loss, fitted with Adam.

    Risk: prior * R(positive as +) + max(0, R(unlabelled as -) - prior * R(positive as -)). One pass over the unlabelled
    rows serves a step of all classifiers.
    """
    w = np.zeros((len(positive), size)) if start is None else start.copy()
    m, v = np.zeros(w.shape), np.zeros(w.shape)
    active = [k for k, p in enumerate(positive) if p is not None]
    for t in range(1, steps + 1):
        risk, slope = unlabelled.negative(w, active)
        for k in active:
            p, pi = positive[k], prior[k]
            fp = p.dot(w[k])
            sp = 1 / (1 + np.exp(-fp))  # d/df log(1 + e^f)
            negative = risk[k] - pi * (p.weight * np.logaddexp(0, fp)).sum()
            down = slope[k] - pi * p.back(sp, size)
            up = pi * p.back(sp - 1, size)
            g = (up + down if negative >= 0 else up) / pi + l2 * w[k]
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            w[k] -= rate / (1 + t / 50) * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    return w


def train_nnpu(positive: Rows, unlabelled: Rows, size: int, prior: float, l2: np.ndarray, start: np.ndarray | None = None, steps: int = STEPS, rate: float = RATE) -> np.ndarray:
    """Weights of one classifier, as train_all() gives them."""
    return train_all([positive], unlabelled, size, [prior], l2, None if start is None else start[None], steps, rate)[0]


class Space:
    """Features, and the labelled sentences in them. Feature 0 is the bias, which every sentence has."""

    def __init__(self, labels: list[tuple[str, str]]):
        reader = Reader()
        bags: dict[str, list[list[set[str]]]] = {c: [] for c in (*CATEGORIES, "none")}
        times: dict[bool, Counter[str]] = {True: Counter(), False: Counter()}
        for text, label in labels:
            if label in bags and (found := sentences(text)):
                bags[label].append(read := [features(s, reader) for s in found])
                # of a confirmed text, its sentences with the most wording groups
                most = max(len(fs & _TELLING) for fs in read) if label != "none" else 0
                times[label != "none"].update(set().union(*(fs for fs in read if len(fs & _TELLING) >= most)))
        names = ["bias", *sorted(GROUPS), *(f"{a} with {b}" for a in _SUBJECTS for b in (*_USES, "another") if a != b), *(f"{a} {x}" for a in _SUBJECTS for x in ("in quotes", "unreported", "plain", "twice"))]
        self.groups = len(names)
        given = set(names)
        bad, good = (max(1, sum(len(bags[c]) for c in of)) for of in (CATEGORIES, ("none",)))
        tells = lambda f, n: n >= MIN_TIMES and n / bad >= INDICATES * (times[False][f] + 0.5) / good
        self.learned = frozenset(f for f, n in times[True].items() if f not in given and tells(f, n) and (f[0] == "#" or max(map(len, f.split())) >= LEAST_LETTERS))
        self.vocabulary = {f: i for i, f in enumerate([*names, *sorted(self.learned)])}
        self.size = len(self.vocabulary)
        self._forms: dict[str, tuple[str, ...]] = {}
        own = lambda s: features(s, reader, self.told)
        row = lambda fs: tuple(sorted({0, *(self.vocabulary[f] for f in fs)}))
        read = {c: [[row(own(s)) for s in sentences(t)] for t, label in labels if label == c and sentences(t)] for c in bags}
        self.bags = {c: read[c] for c in CATEGORIES}
        self.bags["any"] = [bag for c in CATEGORIES for bag in self.bags[c]]
        self.none = Counter(r for bag in read["none"] for r in bag)
        self.subjects = frozenset(self.vocabulary[g] for g in _TELLING) | frozenset(self.vocabulary[f"{g} plain"] for g in _TELLING)

    def told(self, words: list[str]) -> set[str]:
        """Learned features of a sentence's words."""
        out: set[str] = set()
        for w in words:
            if (of := self._forms.get(w)) is None:
                if len(self._forms) > 300_000:
                    self._forms.clear()
                of = self._forms[w] = tuple(x for x in (w, *grams(w)) if x in self.learned)
            out.update(of)
        out.update(x for a, b in zip(words, words[1:], strict=False) if (x := f"{a} {b}") in self.learned)
        return out

    def rows(self, text: str, reader: Reader) -> tuple[int, list[tuple[int, ...]]]:
        """Number of a text's sentences, and the features of those that have more than the bias."""
        v = self.vocabulary
        found = sentences(text)
        rows = (tuple(sorted({0, *(v[f] for f in features(s, reader, self.told))})) for s in found)
        return len(found), [r for r in rows if len(r) > 1]

    def fit(self, rows: Counter[tuple[int, ...]] | SpreadRows, prior: dict[str, float] = PRIOR) -> dict[str, np.ndarray]:
        """Weights of each category from the confirmed texts and unlabelled rows with their counts; texts labelled none join these."""
        l2 = np.where(np.arange(self.size) < self.groups, L2, L2_WORDS)
        l2[0] = 0.0
        if isinstance(rows, SpreadRows):
            u = rows
        else:
            all_rows = rows + self.none
            order = sorted(all_rows)  # sums don't depend on the order in which rows came
            u = Rows(order, [all_rows[r] for r in order])
        none: Counter[tuple[int, ...]] = Counter()
        use = lambda r: tuple(i for i in r if 0 < i < self.groups)
        for r, n in self.none.items():
            none[use(r)] += n
        bags, picked = [], []
        for c in SCORES:
            # to begin with, the sentence with the most wording groups is the confirmed one
            first = [max(b, key=lambda r: (sum(i in self.subjects for i in r), sum(i < self.groups for i in r), len(r))) for b in self.bags[c]]
            # a wrong label: wording groups that stand at least MISLABELLED times as often in texts labelled none
            confirmed = Counter(map(use, first))
            right = [not use(r) or none[use(r)] < MISLABELLED * confirmed[use(r)] for r in first]
            if not any(right):
                right = [True] * len(right)
            bags.append([b for b, ok in zip(self.bags[c], right, strict=True) if ok])
            picked.append([r for r, ok in zip(first, right, strict=True) if ok])
        w = None
        if u.n:
            for _ in range(ROUNDS):
                w = train_all([Rows(p) if p else None for p in picked], u, self.size, [prior[c] for c in SCORES], l2, w)
                picked = [[max(b, key=lambda r: w[k][list(r)].sum()) for b in bags[k]] for k in range(len(SCORES))]
        never = np.where(np.arange(self.size) == 0, -20.0, 0.0)
        return {c: w[k] if w is not None and bags[k] else never for k, c in enumerate(SCORES)}


def read_labels(labels: DataFrame, text: str = "text", label: str = "abuse_label") -> list[tuple[str, str]]:
    """Labelled rows in a fixed order, at most MAX_LABELS, the first by their hash."""
    rows = labels.where((F.length(text) > 0) & F.col(label).isNotNull()).select(text, label)
    return [(r[0], r[1]) for r in rows.orderBy(F.xxhash64(text, label), text, label).limit(MAX_LABELS).collect()]


def featured(rows: DataFrame, space: Space, text: str = "text") -> DataFrame:
    """Texts as feature rows: the other columns, n (sentences), found (features of each sentence that has any)."""
    keep = [c for c in rows.columns if c != text]
    fields = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    shared = rows.sparkSession.sparkContext.broadcast(space)  # of at most MAX_LABELS labelled texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, reader = shared.value, Reader()
        for batch in batches:
            out = [own.rows(t, reader) if t else (0, []) for t in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(keep))] + [pa.array([n for n, _ in out], pa.int32()), pa.array([r for _, r in out], pa.list_(pa.list_(pa.int32())))], names=[*keep, "n", "found"])

    return rows.select(*keep, text).mapInArrow(run, f"{fields}, n int, found array<array<int>>")


def learn(rows: DataFrame, space: Space, prior: dict[str, float] = PRIOR, local: int = LOCAL) -> np.ndarray:
    """Weights (category, feature) from all rows of featured(), equal sentences counted once."""
    total = rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    counted = cut(rows.select(F.explode("found").alias("found")).groupBy("found").agg(F.count("*").alias("n")))
    size = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    rest = Counter({(0,): total - size[1]}) if total > size[1] else Counter()  # sentences with nothing but the bias
    if size[0] <= local:
        return np.stack(list(space.fit(Counter({tuple(r[0]): r[1] for r in counted.collect()}) + rest, prior).values()))
    return np.stack(list(space.fit(SpreadRows(counted, size[1], rest + space.none, space.size), prior).values()))


def probability(rows: list[tuple[int, ...]], n: int, weights: np.ndarray) -> np.ndarray:
    """Score of each category, between 0 and 1, of the worst of n sentences of which rows have features."""
    if not n:
        return np.zeros(len(weights))
    best = np.stack([weights[:, list(r)].sum(axis=1) for r in rows] + ([weights[:, 0]] if n > len(rows) else [])).max(axis=0)
    return 1 / (1 + np.exp(-best))


def comments(text: str | None) -> list[tuple[int, str]]:
    """(id, text) of every comment of a tree, in any depth; [] if it can't be read."""
    if not text:
        return []
    try:
        todo, out = [json.loads(text)], []
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                try:
                    x = json.loads(x)
                except ValueError:
                    continue
            if isinstance(x, list):
                todo.extend(x)
            elif isinstance(x, dict):
                c = x.get("comment")
                if isinstance(c, dict):
                    i, t = c.get("id"), c.get("comment")
                    if isinstance(t, str) and t.strip() and not isinstance(i, bool) and re.fullmatch(r"\s*\d{1,18}\s*", str(i)):
                        out.append((int(i), t))
                todo.extend(v for v in x.values() if isinstance(v, (list, dict)) and v is not c)
        return out
    except RecursionError:  # very deep trees are read by tokens
        found: dict[tuple, dict[str, str | None]] = {}
        try:
            for path, at, value, _ in nested.scan(text):
                if path[-2:-1] == ("comment",) and path[-1] in ("id", "comment"):
                    found.setdefault(at, {})[path[-1]] = value
        except nested.Unreadable:
            return []
        return [(int(v["id"]), v["comment"]) for v in found.values() if v.get("comment") and re.fullmatch(r"\d{1,18}", v.get("id") or "")]
    except ValueError:
        return []


def comment_rows(news: DataFrame) -> DataFrame:
    """Comments of all news rows: source, item_kind, item_id, text; once for each distinct text of an id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, c, t) for i, tree in enumerate(batch.column(1).to_pylist()) for c, t in comments(tree)]
            cols = list(zip(*rows, strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string())], names=["source", "item_id", "text"])

    found = news.select(F.col("source_site").alias("source"), "comments").mapInArrow(run, "source string, item_id bigint, text string")
    return found.select("source", F.lit("comment").alias("item_kind"), "item_id", "text")


def items(reviews: DataFrame, news: DataFrame) -> DataFrame:
    """Everything that is scored: source, item_kind, item_id, text."""
    own = spread(reviews.select(F.lit("reviews").alias("source"), F.lit("review").alias("item_kind"), F.col("review_id").alias("item_id"), F.col("body_text").alias("text")))
    return own.unionByName(comment_rows(spread(news.select("source_site", "comments")))).where("item_id IS NOT NULL AND length(text) > 0")


def scored(rows: DataFrame, weights: np.ndarray) -> DataFrame:
    """Rows of featured() with a score for each category in place of their features."""
    keep = [c for c in rows.columns if c not in ("n", "found")]
    fields = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = np.array([probability(found, n, weights) for n, found in zip(batch.column(len(keep)).to_pylist(), batch.column(len(keep) + 1).to_pylist(), strict=True)]).reshape(-1, len(SCORES))
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(keep))] + [pa.array(s[:, k]) for k in range(len(SCORES))], names=[*keep, *SCORES])

    return rows.select(*keep, "n", "found").mapInArrow(run, f"{fields}, " + ", ".join(f"{c} double" for c in SCORES))


def scores(reviews: DataFrame, news: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of every review and comment; an item's worst where it stands more than once."""
    space = Space(read_labels(labels))
    rows = cut(featured(items(reviews, news), space))
    return scored(rows, learn(rows, space)).groupBy("source", "item_kind", "item_id").agg(*(F.max(c).alias(c) for c in SCORES))


def found(reviews: DataFrame, news: DataFrame, labels: DataFrame) -> DataFrame:
    return scores(reviews, news, labels).where(F.greatest(*SCORES) >= THRESHOLD).select("item_kind", "item_id").distinct()


def rates(reviews: DataFrame, news: DataFrame, labels: DataFrame) -> DataFrame:
    """Items of each source, and the share of them in each category."""
    s = cut(scores(reviews, news, labels))
    return s.groupBy("source", "item_kind").agg(F.count("*").alias("items"), *(F.avg((F.col(c) >= THRESHOLD).cast("double")).alias(f"{c}_rate") for c in CATEGORIES), F.avg((F.greatest(*SCORES) >= THRESHOLD).cast("double")).alias("any_rate"))
