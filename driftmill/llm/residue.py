"""Template residue, filler, error pages and script notices in place of content.

Records are split into parts (heading, title, description, body) and parts into sentences. A sentence is a candidate if
half of its words are words that messages are made of, as its words of meaning or between them; a part of which candidates
and unfilled slots make up less than SHARE of the characters can't be residue and goes no further, so ordinary texts leave
the stage that reads them with nothing. Equal candidates are counted, and go through a fixed-depth prefix tree: by number of
words, then by the first DEPTH words with numbers masked; within a leaf, most frequent first, a sentence joins the most
similar template, and places where the two differ become wildcards. A leaf may hold any number of sentences of any
length: its templates are looked up by the words at their places, and of a sentence only its hash and the number of its
template are held until the leaf ends. Every template is classified once, by a model fitted on SEEDS and PLAIN over its
words, its fixed wording and the number of parts that it stands in, and verdicts go back to the sentences by hash. A
sentence that is a message by itself stays one, whatever its template.
The tree is built from counts of all records, so results don't depend on partitions or on the order of rows. Slots that
were never filled are found apart from that, inside ordinary records too.

A part is residue if sentences of residue make up at least SHARE of its characters. Empty parts are nothing, and
sentences that only mention a slot or a message among other words aren't residue.

Defined results: null and empty parts are left out; a record without any text isn't listed; very long texts are read
whole; rows of one key are judged each by itself, and the key counts once; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import batched

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftmill.llm import pages
from driftmill.session import cut, join_hot, spread

#: First words that make the path to a leaf; share of equal words from which a sentence joins a template; verdicts of a leaf that are given out at once.
DEPTH, SIMILAR, LEAF = 3, 0.6, 2000
#: Share of a candidate's words that must be of messages.
COVERED = 0.5
#: Share of a part's characters that must be residue.
SHARE = 0.9
WILD = "<*>"

_SENTENCE = re.compile(r"(?<=[.!?…])\s+(?=[A-ZА-ЯЁ0-9«“\"(\[{<%$#_])|\n+")
_NUMBER = re.compile(r"\d+")
_NAME = r"[\w.а-яёА-ЯЁ -]{1,40}"
#: A slot that should have been filled, in the usual template languages.
SLOT = re.compile(
    rf"\{{\{{\s*{_NAME}\s*\}}\}}|\$\{{\s*{_NAME}\s*\}}|#\{{\s*{_NAME}\s*\}}|\{{%.{{1,60}}?%\}}|<%[=-]?.{{1,60}}?%>|\[\[\s*{_NAME}\s*\]\]|%[A-Za-zА-Яа-яЁё_.]{{2,40}}%|__[A-Za-zА-Яа-яЁё][\w.]*?__"
    rf"|(?<![\w}}\\])\{{[A-Za-zА-Яа-яЁё_][\w.]{{1,40}}\}}|\[(?:вставьте|insert|укажите|your|ваш[еа]?)\b[^\]\n]{{0,60}}\]|\b(?:TODO|FIXME|TBD|XXX):?\s+[\w.]{{1,40}}",
    re.IGNORECASE,
)
_OUTSIDE = re.compile(r"[\w]")

#: Wording of messages as whole sentences, lower case, numbers masked as 0 (fixed values). Each is matched in full.
MESSAGES = {
    "error": (
        r"(?:0 ?[—:.-]* ?)?(?:такой страницы (?:нет|не существует)|страниц[аы] не (?:найден[аы]|существует)|ничего не найдено|not found|page (?:was )?not found|the page you (?:requested|are looking for).*)",
        r"(?:упс|ой|oops)[!,.]?.*", r"здесь ничего нет.*", r"we (?:could not|couldn.t|can.t) find .*", r"(?:страницу|её|запись) удалили(?: или переместили)?",
        r"(?:произошла )?(?:внутренняя )?ошибка(?: сервера)?(?: 0)?", r"(?:пожалуйста, )?попробуйте (?:обновить страницу|позже|ещё раз).*", r"(?:please )?try again(?: later)?", r"(?:please )?(?:retry|come back) (?:later|soon)",
        r"(?:internal )?server error.*", r"(?:http )?(?:error )?0 ?(?:bad gateway|forbidden|not found|internal server error|service (?:temporarily )?unavailable|gateway time-?out|too many requests|moved permanently|found|bad request|unauthorized|gone)?",
        r"bad gateway", r"gateway time-?out", r"bad request", r"upstream .*", r"something went wrong.*", r"что-то пошло не так.*",
        r"(?:the )?(?:service|site|server|page)(?: is)?(?: temporarily)? unavailable.*", r"(?:сайт|сервис|сервер|страница|база данных)(?: временно)? (?:недоступн\w+|не отвечает).*", r"(?:ведутся )?технические работы.*", r"мы уже чиним.*", r"under maintenance.*",
        r"(?:доступ ограничен[:,]? )?слишком много запросов.*", r"too many requests.*", r"доступ (?:ограничен|запрещ[её]н|закрыт).*", r"access (?:denied|restricted).*", r"forbidden", r"your (?:request|ip|access) (?:was|has been|is) (?:blocked|denied).*",
        r"(?:материал|контент|страница|просмотр) ограничен\w*.*", r"только для взрослых.*", r"adults only[:,.].*", r"(?:вам должно быть|подтвердите, что вам) .*(?:18|0).*", r"you must be 0.*", r"войдите, чтобы (?:продолжить|посмотреть).*", r"(?:please )?(?:log|sign) in to (?:continue|view).*", r"age.restricted.*",
        r"(?:эта )?страница (?:переехала|перемещена|перенесена).*", r"(?:this|the) page (?:has )?moved.*", r"обновите закладк[уи]", r"(?:object|document) moved.*", r"(?:you are being )?redirect(?:ed|ing).*", r"перенаправлени[ея].*",
        r"подтвердите, что вы не робот.*", r"(?:please )?(?:verify|confirm|prove) (?:that )?you(?:.re| are) (?:not a robot|human).*", r"(?:checking|verifying) your browser.*", r"проверк[аи] (?:вашего )?браузера.*", r"(?:just|one) (?:a )?moment.*", r"captcha.*",
        r"код (?:запроса|ошибки) 0", r"(?:request|error|ray) (?:id|code)[: ]*[\w-]+", r"(?:вернуться|перейти) на главную(?: страницу)?", r"(?:back|return|go) (?:to )?(?:the )?home(?: ?page)?",
    ),
    "script": (
        r"(?:пожалуйста, )?(?:для работы .*)?(?:включите|разрешите) (?:javascript|скрипты|js).*", r".*(?:you need to|please|must) (?:enable|turn on|allow) (?:javascript|scripts?).*", r"(?:this|the) (?:app|site|page) (?:needs|requires) (?:javascript|scripts?).*", r"turn (?:them|it|scripts) on(?: and reload)?",
        r"ваш браузер не поддерживает .*", r"your browser (?:does not|doesn.t) support .*", r"(?:javascript|скрипты) (?:is |are )?(?:disabled|отключ[её]ны?).*", r"(?:контент|содержимое) не загруж\w+", r"загрузка", r"loading", r"please wait", r"подождите.*загру.*",
    ),
    "filler": (
        r"(?:sed|lorem|ipsum|dolor|sit|amet|consectetur|adipiscing|elit|eiusmod|tempor|incididunt|ut|labore|et|dolore|magna|aliqua|enim|ad|minim|veniam|quis|nostrud|exercitation|ullamco|laboris|nisi|aliquip|ex|ea|commodo|consequat|duis|aute|irure|in|reprehenderit|voluptate|velit|esse|cillum|eu|fugiat|nulla|pariatur|excepteur|sint|occaecat|cupidatat|non|proident|sunt|culpa|qui|officia|deserunt|mollit|anim|id|est|laborum|do|[ ,;:-])+",
        r"(?:(?:test|тест|проверка|asdf|qwerty|йцукен|foo|bar|baz|xxx|bla|blah|бла|рыба|текст|text|sample|пример|проба)[ ,;:-]*)+0?", r"рыбный (?:абзац|текст).*", r"(?:sample|dummy|placeholder|example|filler) (?:text|content|title|paragraph)(?: (?:goes )?here)?.*", r"(?:your )?(?:text|content|title|description) (?:goes|will be) here.*",
        r"(?:здесь|тут) (?:будет|должен быть|скоро (?:будет|появится)|появится) .*", r"(?:текст|описание|заголовок|название) (?:появится|будет) .*", r"coming soon.*", r"(?:скоро здесь .*|под строительством|under construction)", r"(?:(?:null|undefined|nan|none|n/a)[ ,;]*)+", r"текст-заполнитель.*", r"замените (?:его|этот текст) .*", r"replace (?:this|it|me) .*", r"\[object object\]", r"(?:без (?:названия|имени|заголовка|темы)|untitled(?: ?0)?|no title|(?:new|новая) (?:page|страница|запись)|new document|новый документ|новость|заголовок|title|description|описание)(?: 0)?",
    ),
}
_JUDGE = {kind: re.compile("|".join(f"(?:{p})" for p in wording)) for kind, wording in MESSAGES.items()}


def masked(sentence: str) -> str:
    """A sentence as it is compared: lower case, numbers masked, spaces single, end marks off."""
    return _NUMBER.sub("0", " ".join(sentence.lower().split())).strip(" .!…?*")


def only_slots(sentence: str) -> bool:
    """Whether nothing but unfilled slots stands in a sentence."""
    rest, n = SLOT.subn(" ", sentence)
    return n > 0 and not _OUTSIDE.search(rest)


# --- the model

#: Beginnings of the words that messages are made of, by their role, and words that stand between them (fixed values).
ROLES = {
    "subject": "page site website server connect request access account address link url file document resource content service application app host gateway database session token domain user browser javascript js script cookie captcha robot bot network traffic system api administrator internal video image страниц сайт сервер соедин подключ запрос доступ аккаунт адрес ссылк файл документ ресурс контент сервис приложен шлюз баз данны сесси время домен пользовател браузер скрипт куки капч робот сеть сети базе базы систем материал администратор внутренн",
    "state": "found missing delet remov expir unavailable denied deny block limit timed timeout out fail error forbid restrict invalid broken clos disabl down unauthor overload exceed maintenance gone unsupport outdat suspend bann moved redirect unknown wrong reject refus interrupt unreachable offline rate exist display support brok найд найт найден существу удал истек истёк недоступ отказ заблокир огранич превы ошибк сбой запре закры отключ неверн недейств перегруж обслужив пуст перемещ перенес переех прерван невозможн неизвестн произош авторизован отказан отклон поддержив устарел техническ временно",
    "action": "enabl allow turn accept reload refresh retr try tries again later wait check verif confirm prov log logged login sign continue view return back home contact click updat install switch load loading shown human required require need must включ разреш обнов увидеть попроб повтор позже подожд провер подтверд войд войти авториз зарегистр продолж верн перейд перейт нажм установ загру требуется необходимо",
    "filler": "lorem ipsum dolor amet placeholder dummy sample filler test untitled undefined null nan todo coming soon asdf qwerty заглушк заполнител образец пример рыб тест скоро появится заполн описани заголов текст text title description goes insert вставьте",
}
BETWEEN = frozenset(
    "the a an this that these those is are was were has have had been be being to for of in on at by with or and not no nor your you we our it its from can could cannot will would may might if so as do does did please sorry there here too many much more some any all once only just oops until when while he"
    " здесь такой такая такого не ни в на и для с со по к из от это эта этот эту этой этого вы вам вас ваш ваша ваше вашего мы нас наш его её ее их или чтобы что то как был была было были будет уже больше ещё еще пока нет при без за до о об под над же ли бы она он они слишком много можно нужно пожалуйста извините увы к сожалению 0".split()
)
#: Messages that the model is fitted on, and ordinary sentences with words of messages (fixed values).
SEEDS = (
    "page not found", "the requested page could not be found", "the file has been removed", "this account has been suspended", "access to this resource is denied", "your request was blocked", "request failed", "internal server error", "server is down for maintenance", "the service is unavailable", "your session has expired", "please log in to continue", "please enable javascript", "you need to allow scripts to view this site", "your browser is not supported", "cookies are disabled", "please wait while we check your browser", "verify that you are human", "too many requests", "try again later", "reload the page", "loading", "this content is restricted", "the link is broken", "invalid address", "database error", "gateway timeout", "the page has moved", "the page cannot be shown", "you have been logged out", "you are offline", "you are not allowed to do this", "you must wait", "error 0", "page deleted", "the document does not exist", "network is unreachable", "the connection was refused", "return to the home page", "lorem ipsum", "placeholder text", "sample text", "coming soon", "text goes here", "untitled", "undefined",
    "страница не найдена", "такой страницы не существует", "файл был удалён", "доступ запрещён", "доступ к сайту ограничен", "ваш аккаунт заблокирован", "произошла ошибка", "внутренняя ошибка сервера", "сервер временно недоступен", "сервис на техническом обслуживании", "время сессии истекло", "вы не авторизованы", "вам отказано", "вы отключены от сети", "войдите, чтобы продолжить", "включите javascript", "разрешите скрипты, чтобы увидеть страницу", "ваш браузер не поддерживается", "подтвердите, что вы не робот", "слишком много запросов", "попробуйте позже", "обновите страницу", "загрузка", "материал удалён", "ссылка недействительна", "соединение прервано", "ошибка подключения к базе данных", "страница перемещена", "запрос отклонён сервером", "здесь появится текст", "скоро здесь появится описание", "пример заголовка", "заголовок",
)
PLAIN = (
    "the hero needs access to the old server room", "a page of the diary is missing", "the studio moved the premiere to autumn", "she returns home and waits for a letter", "the script is weak but the dub works", "he must find the link between two cities", "the service at the hotel was lovely", "fans tried to contact the director", "the film was banned in two countries", "episode 0 was removed from the schedule", "he tries again and fails the exam", "the network announced a new season", "the robot learns to paint", "a test of courage on the roof", "the title song is sung by a choir", "the account of the war is honest", "the site of the battle is a field today", "nobody checks the lighthouse at night", "the system of magic is simple", "soon the captain comes back", "back home", "found", "contact", "a script with charm", "the link that binds them", "the human", "the last server", "text", "access denied, the movie",
    "герой ищет страницу, которая не найдена", "студия перенесла премьеру на осень", "сайт студии назвал дату выхода", "сценарий просит терпения, а финал смазан", "робот учится рисовать", "серия 0 вышла вчера", "герой возвращается домой и ждёт письма", "доступ к архиву получил только капитан", "запись концерта вышла на диске", "ошибка режиссёра в том, что он спешит", "тест на смелость проходит на крыше", "текст песни написал поэт", "описание города заняло две главы", "скоро начнётся турнир", "сервер гильдии стоит в подвале школы", "материал снят на плёнку", "система магии проста", "злодей запрещает праздники", "новость обрадовала фанатов", "по данным за 0 год", "разработчик показал шаблон прямо в интервью", "она включает свет и видит письмо", "робот", "сеть", "тест", "последняя страница", "сайт студии закрыт", "дружба на проверку", "путь домой найден",
)
READER = frozenset("you your please sorry вы вам вас ваш ваша ваше вашего пожалуйста извините".split())
_STEMS: dict[str, str] = {stem: role for role, stems in ROLES.items() for stem in stems.split()}
_LONGEST = max(map(len, _STEMS))
_WORD = re.compile(r"[^\W_]+(?:[’'][^\W_]+)?")
_ROLE_NAMES = tuple(ROLES)
#: Short stems that must be the whole word.
_WHOLE = frozenset(s for s in _STEMS if len(s) <= 3) | {"test", "text", "link", "home", "moved", "user", "тест", "сеть", "title", "host", "back", "view", "sign", "need", "must", "page", "site", "file", "load", "soon"}
_ENDING = re.compile(r"(?:s|ed|d|es|ing|ting)?")


@lru_cache(200_000)
def role(word: str) -> str:
    """Role of a word in messages: one of ROLES, ``between``, or empty."""
    if word in BETWEEN or word.isdigit():
        return "between"
    for n in range(min(len(word), _LONGEST), 1, -1):
        if (found := _STEMS.get(word[:n])) and (n == len(word) or word[:n] not in _WHOLE or _ENDING.fullmatch(word[n:]) and n > 3):
            return found
    return ""


def roles(template: str) -> list[str]:
    return [role(w) for w in _WORD.findall(template)]


#: Weights from which fitting starts: bias, share of words of messages, words that are none (up to 5), whether a subject, a state or action, both, a word of fillers occurs, the fixed wording, log of the parts it stands in, tens of words (up to 2), whether it speaks to a reader.
PRIOR = (-9.0, 7.0, -3.0, 0.5, 1.0, 2.0, 3.0, 9.0, 0.2, -0.5, 1.0)


def template_features(template: str, parts: int = 1) -> tuple[float, ...]:
    of = roles(template)
    other, subject, told = sum(not r for r in of), "subject" in of, "state" in of or "action" in of
    return (1.0, (len(of) - other) / max(1, len(of)), float(min(5, other)), float(subject), float(told), float(subject and told), float("filler" in of), float(wording(template) is not None), math.log2(min(max(1, parts), 1024)), min(20, len(of)) / 10, float(not READER.isdisjoint(_WORD.findall(template))))


@lru_cache(1)
def weights() -> tuple[float, ...]:
    """The model: a logistic classifier, the likeliest for SEEDS and PLAIN under a normal prior around PRIOR."""
    x = np.array([template_features(masked(t)) for t in (*SEEDS, *PLAIN)])
    y = np.array([1.0] * len(SEEDS) + [0.0] * len(PLAIN))
    w = prior = np.array(PRIOR)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w = w - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.eye(len(w)), x.T @ (p - y) + (w - prior))
    return tuple(float(v) for v in w)


@lru_cache(200_000)
def wording(plain: str) -> str | None:
    """Kind of message whose fixed wording a sentence has in full."""
    plain = " ".join(plain.replace(WILD, "0").split())
    if plain == "0":
        return None
    return next((kind for kind, shape in _JUDGE.items() if shape.fullmatch(plain)), None)


def judge(template: str, parts: int = 1) -> str | None:
    """Kind of message that a template is, or None. A template with wildcards is judged by the words that stayed; parts: how many it stands in."""
    if template.strip() == "0":
        return "error"
    if kind := wording(template):
        return kind
    of = roles(template)
    if not any(r and r != "between" for r in of) or sum(map(float.__mul__, weights(), template_features(template, parts))) < 0:
        return None
    if "filler" in of and of.count("filler") >= max(of.count("state"), of.count("action")):
        return "filler"
    return "script" if re.search(r"javascript|\bjs\b|script|скрипт|браузер|browser|загру|loading", template) else "error"


def candidate(masked_sentence: str) -> bool:
    """Whether a sentence may be a message, by itself or by its template."""
    of = [role(w) for w in _WORD.findall(masked_sentence)]
    return (sum(map(bool, of)) >= COVERED * len(of) and any(r and r != "between" for r in of)) or masked_sentence == "0" or wording(masked_sentence) is not None


class Tree:
    """Prefix tree of fixed depth over masked sentences; its templates only ever gain wildcards."""

    def __init__(self, depth: int = DEPTH) -> None:
        self.leaves: dict[tuple, list[list[str]]] = {}
        self.at: dict[tuple, dict[tuple[int, str], array]] = {}  # of a leaf: templates that have or had a word at a place
        self.depth = depth

    def find(self, sentence: str) -> tuple[list[list[str]], int]:
        """Leaf and number of the template that the sentence belongs to, which it widens.

        A template that is similar enough agrees in one of any places that are more than may differ, so only those are
        compared that have the sentence's word at one of that many places, where the fewest templates have it. Where these
        are many, as among sentences of few different words, the places that a template has or had in common are counted
        first, and only those are compared that may have enough; the result is the same.
        """
        words = sentence.split(" ")
        path = (len(words), *words[: self.depth])
        leaf, at = self.leaves.setdefault(path, []), self.at.setdefault(path, {})
        best, most = None, SIMILAR * len(words)
        places = range(self.depth, len(words))
        differ = int(len(words) - most + 1e-9) + 1
        if differ > len(places):
            near = range(len(leaf))
        else:
            held = sorted((at.get((i, words[i]), ()) for i in places), key=len)
            if sum(map(len, held[:differ])) * len(words) <= sum(map(len, held)) // 16 + 1000:
                near = sorted(set().union(*held[:differ]))
            else:
                shared = np.bincount(np.concatenate([np.frombuffer(x, np.int32) for x in held if x]))
                near = np.flatnonzero(shared + self.depth >= most).tolist()
        for n in near:
            same = sum(map(str.__eq__, leaf[n], words))
            if same >= most:
                best, most = n, same
        if best is None:
            leaf.append(words)
            best = len(leaf) - 1
            for i in places:
                at.setdefault((i, words[i]), array("i")).append(best)
        elif most < len(words):
            template = leaf[best]
            for i in places:
                if template[i] != words[i] and template[i] != WILD:
                    template[i] = WILD
                    at.setdefault((i, WILD), array("i")).append(best)
        return leaf, best

    def add(self, sentence: str) -> list[str]:
        """The template that the sentence belongs to, as a list that later sentences may still widen."""
        leaf, n = self.find(sentence)
        return leaf[n]


KINDS = (None, *MESSAGES)


class Leaf:
    """Sentences of one leaf as they come, most frequent first; of each it keeps its key, its own verdict and the number of its template."""

    def __init__(self) -> None:
        self.tree, self.templates = Tree(), []
        self.parts: list[int] = []  # of each template
        self.keys, self.numbers, self.own = array("q"), array("q"), array("b")

    def add(self, key: int, sentence: str, parts: int) -> None:
        self.templates, n = self.tree.find(sentence)
        if n == len(self.parts):
            self.parts.append(0)
        self.parts[n] += parts
        self.keys.append(key)
        self.numbers.append(n)
        self.own.append(KINDS.index(judge(sentence, parts)))

    def verdicts(self) -> Iterator[tuple[int, str]]:
        """Key and kind of each sentence that is a message by its template or by itself."""
        kinds = [judge(" ".join(t), n) for t, n in zip(self.templates, self.parts, strict=True)]
        for key, n, own in zip(self.keys, self.numbers, self.own, strict=True):
            if kind := kinds[n] or KINDS[own]:
                yield key, kind


def classified(leaf: list[tuple[str, int]]) -> list[str | None]:
    """Verdict for each (sentence, parts that hold it) of one leaf: that of its template, or its own. The order of the sentences doesn't matter."""
    held = Leaf()
    for i in sorted(range(len(leaf)), key=lambda i: (-leaf[i][1], leaf[i][0])):
        held.add(i, *leaf[i])
    kinds = dict(held.verdicts())
    return [kinds.get(i) for i in range(len(leaf))]


def sentences(text: str) -> list[str]:
    return [s for s in (x.strip() for x in _SENTENCE.split(text)) if s]


def mined(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Parts (keys, part, text) that may be residue: keys, part, row (hash of the text), total and slots (characters), said.

    said: the candidates of the part, each once: hash, chars, text. Parts of which candidates and slots make up less than
    SHARE of the characters are left out.
    """
    fields = ", ".join(f"`{k}` {parts.schema[k].dataType.simpleString()}" for k in keys)
    n = len(keys)
    kind = pa.list_(pa.struct([("hash", pa.int64()), ("chars", pa.int64()), ("text", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, bool] = {}
        for batch in batches:
            rows: list[tuple] = []
            for i, text in enumerate(batch.column(n + 1).to_pylist()):
                total = slots = held = 0
                said: dict[str, int] = {}
                for s in sentences(text):
                    if only_slots(s):
                        slots += len(s)
                        total += len(s)
                        continue
                    if not (m := masked(s)):
                        continue
                    total += len(s)
                    if (fits := known.get(m)) is None:
                        fits = candidate(m)
                        if len(known) > 100_000:
                            known.clear()
                        if len(m) < 500:
                            known[m] = fits
                    if fits:
                        held += len(s)
                        said[m] = said.get(m, 0) + len(s)
                if total and slots + held >= SHARE * total:
                    told = [{"hash": xxhash.xxh64_intdigest(m) >> 1, "chars": c, "text": m} for m, c in said.items()]
                    rows.append((i, xxhash.xxh64_intdigest(text) >> 1, total, slots, told))
            take = pa.array([r[0] for r in rows], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(j).take(take) for j in range(n + 1)] + [pa.array([r[k] for r in rows], pa.int64()) for k in (1, 2, 3)] + [pa.array([r[4] for r in rows], kind)],
                names=[*keys, "part", "row", "total", "slots", "said"],
            )

    return parts.where(F.length(F.trim("text")) > 0).select(*keys, "part", "text").mapInArrow(run, f"{fields}, part string, row bigint, total bigint, slots bigint, said array<struct<hash: bigint, chars: bigint, text: string>>")


def verdicts(told: DataFrame) -> DataFrame:
    """Candidates (hash, text; a row for every part) that are messages: hash, kind. Each distinct sentence and template is classified once."""
    words = F.split("text", " ")
    path = F.concat_ws(" ", F.size(words).cast("string"), F.slice(words, 1, DEPTH))
    counted = told.groupBy("hash", "text").agg(F.count("*").alias("parts")).withColumn("leaf", path)

    size = LEAF

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(found: Iterable[tuple[int, str]]) -> Iterator[pa.RecordBatch]:
            for some in batched(found, size):
                yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in some], pa.int64()), pa.array([k for _, k in some], pa.string())], names=["hash", "kind"])

        now, leaf = None, Leaf()  # rows of one leaf stand together
        for batch in batches:
            for path, h, t, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if path != now:
                    yield from out(leaf.verdicts())
                    now, leaf = path, Leaf()
                leaf.add(h, t, n)
        yield from out(leaf.verdicts())

    order = ["leaf", F.desc("parts"), "text"]
    return counted.select("leaf", "hash", "text", "parts").repartition("leaf").sortWithinPartitions(*order).mapInArrow(run, "hash bigint, kind string")


def residue_parts(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Parts that are residue: keys, part, share, kind (of most of it; ``placeholder`` for slots)."""
    rows = cut(mined(parts, keys))
    of = [*keys, "part", "row"]
    said = rows.select(*of, "total", "slots", F.explode_outer("said").alias("x")).select(*of, "total", "slots", F.col("x.hash").alias("hash"), F.col("x.chars").alias("chars"), F.col("x.text").alias("text"))
    found = cut(verdicts(said.where("hash IS NOT NULL").select("hash", "text")))
    # one message may stand in a third of all records
    judged = join_hot(said.drop("text"), found, "hash", rows=found.count())
    per_kind = judged.groupBy(*of, "kind").agg(F.sum(F.when(F.col("kind").isNotNull(), F.col("chars")).otherwise(0)).alias("chars"), F.max("total").alias("total"), F.max("slots").alias("slots"))
    best = F.struct("chars", "kind")
    whole = per_kind.groupBy(*of).agg(F.sum("chars").alias("chars"), F.max("total").alias("total"), F.max("slots").alias("slots"), F.max(best).alias("most"))
    share = (F.col("chars") + F.col("slots")) / F.col("total")
    return whole.select(*keys, "part", share.alias("share"), F.when(F.col("slots") >= F.col("most.chars"), F.lit("placeholder")).otherwise(F.col("most.kind")).alias("kind")).where(F.col("share") >= SHARE)


def slots(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """Unfilled slots inside any text: keys, slot, times; also in records that are otherwise sound."""
    fields = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[tuple[int, str], int] = {}
            for i, t in enumerate(batch.column(len(keys)).to_pylist()):
                for m in SLOT.finditer(t):
                    rows[i, m[0]] = rows.get((i, m[0]), 0) + 1
            take = pa.array([i for i, _ in rows], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(j).take(take) for j in range(len(keys))] + [pa.array([s for _, s in rows], pa.string()), pa.array(list(rows.values()), pa.int32())], names=[*keys, "slot", "times"])

    return df.where(F.col(text).rlike(r"[{}%\[\]]|__|(?iu:TODO|FIXME|TBD|XXX)")).select(*keys, F.col(text).alias("__text")).mapInArrow(run, f"{fields}, slot string, times int")


KEYS = ["source_table", "record_key"]


def _parts(df: DataFrame, name: str, key: str, parts: list[tuple[str, object]]) -> DataFrame:
    told = F.explode(F.array(*(F.struct(F.lit(p).alias("part"), t.alias("text")) for p, t in parts)))
    return df.select(F.lit(name).alias("source_table"), F.col(key).cast("string").alias("record_key"), told.alias("x")).select("source_table", "record_key", "x.part", "x.text").where(F.length(F.trim("text")) > 0)


def _first(*names: str):
    """First of several columns that isn't empty."""
    return F.coalesce(*(F.nullif(F.trim(n), F.lit("")) for n in names))


def anime_parts(pages_table: DataFrame) -> DataFrame:
    """Heading with title, and description. The page's HTML title counts only where both others are missing."""
    head = F.coalesce(F.nullif(F.concat_ws("\n", _first("title_heading"), _first("title")), F.lit("")), F.col("html_title"))
    return _parts(pages_table, "anime_pages", "source_file", [("head", head), ("description", F.col("description"))])


def news_parts(news: DataFrame) -> DataFrame:
    """Title, foreword and body. The page's HTML title counts only where title and body are missing."""
    body = _first("content_text", "content_html")
    return _parts(news, "news", "source_id", [("head", F.when(_first("title").isNotNull(), F.col("title")).when(body.isNull(), F.col("page_title"))), ("description", F.col("foreword")), ("body", body)])


def page_parts(bodies: DataFrame) -> DataFrame:
    """Heading with title, and body, of pages.page_bodies. The HTML title alone counts only where there is no body."""
    first = F.try_element_at("blocks", F.lit(1))
    headed = first["tag"].isin("h1", "h2")
    rest = F.when(headed, F.slice("blocks", F.lit(2), F.greatest(F.size("blocks") - 1, F.lit(0)))).otherwise(F.col("blocks"))
    head = F.when(headed, F.concat_ws("\n", first["text"], F.col("title"))).when(F.size("blocks") == 0, F.col("title"))
    return _parts(bodies, "raw_pages", "url", [("head", head), ("body", F.array_join(F.transform(rest, lambda b: b["text"]), "\n"))])


def records(parts: DataFrame) -> DataFrame:
    """Records of which a part is residue: source_table, record_key, once each."""
    return residue_parts(parts, KEYS).select(*KEYS).distinct()


def all_parts(anime_pages: DataFrame, news: DataFrame, bodies: DataFrame) -> DataFrame:
    """Parts of the records of all three tables, raw_pages as page_bodies: source_table, record_key, part, text."""
    return anime_parts(spread(anime_pages)).unionByName(news_parts(spread(news))).unionByName(page_parts(bodies))


def found(anime_pages: DataFrame, news: DataFrame, raw_pages: DataFrame) -> DataFrame:
    return records(all_parts(anime_pages, news, pages.page_bodies(raw_pages)))


def slots_found(anime_pages: DataFrame, news: DataFrame, raw_pages: DataFrame) -> DataFrame:
    """Unfilled slots of every part, sound records included: source_table, record_key, part, slot, times."""
    return slots(all_parts(anime_pages, news, pages.page_bodies(raw_pages)), [*KEYS, "part"], "text").distinct()


def body_blocks_found(raw_pages: DataFrame, anime_pages: DataFrame | None = None, news: DataFrame | None = None) -> DataFrame:
    """Blocks of body text of every page that isn't residue: url, block_md5, once each.

    With anime_pages and news the pages left out are those of found, whose templates are counted over all three tables;
    without them templates are counted over the pages alone.
    """
    bodies = cut(pages.page_bodies(raw_pages))
    parts = page_parts(bodies) if anime_pages is None or news is None else all_parts(anime_pages, news, bodies)
    bad = cut(records(parts).where("source_table = 'raw_pages'").select(F.col("record_key").alias("url")))
    blocks = bodies.select("url", F.explode("blocks").alias("b")).select("url", F.md5(F.trim(F.regexp_replace("b.text", r"(?U)[\s\x1c-\x1f]+", " "))).alias("block_md5"))
    return join_hot(blocks, bad, "url", "left_anti", rows=bad.count()).distinct()
