"""Personal information in free text: found, scored, replaced by typed placeholders.

Regular expressions propose spans; validators (Luhn, mod-97, and the check digits of tax and insurance numbers) raise the
score of those they confirm, and a number that a strong validator confirms needs no word beside it; words close by
raise or lower the score; spans that reach ACCEPT stay. Where spans overlap the higher score wins, then the longer one,
then the earlier one. All of it happens where the text is read: nothing is shuffled, and only the spans, or the rewritten
text, leave the stage.

Kinds: email, phone, id_number, address, person_name. Names are told by initials, a patronymic, a cue before them, or,
in a plain sentence, by a score of their shape, a common given name, the ending of the family name and the words beside
them. Names that the given list holds are public and stay, in either order of first and family name and also with the
first name cut to its initial. A list of more than MAX_NAMES names isn't broadcast: the candidates of each text are joined
with it, and each text is then read with those that it holds.

Defined results: a null text gives no spans and stays null; an empty text stays empty; a very long text is read whole;
equal texts give equal spans; a null or empty name list spares nobody.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftmill.session import cut, join_hot, spread

ACCEPT = 1.0
#: Names of the list up to which it travels with the job; a longer list is joined with the candidates of the texts.
MAX_NAMES = 1_000_000
#: Characters before and after a span whose words count as its context.
BEFORE, AFTER = 48, 32
PLACEHOLDERS = {"email": "[EMAIL]", "phone": "[PHONE]", "id_number": "[ID_NUMBER]", "address": "[ADDRESS]", "person_name": "[PERSON]"}

# --- e-mail: the signs for @ and the dot may be written out
_AT = r"(?:@|[ \xa0]@[ \xa0]|[ \xa0]?\[[ ]?at[ ]?\][ \xa0]?|[ \xa0]?\([ ]?(?:at|собака)[ ]?\)[ \xa0]?|[ \xa0]собака[ \xa0]|[ \xa0]at[ \xa0])"
_DOT = r"(?:\.|[ \xa0]?\[[ ]?dot[ ]?\][ \xa0]?|[ \xa0]?\([ ]?(?:dot|точка)[ ]?\)[ \xa0]?|[ \xa0](?:dot|точка)[ \xa0])"
_EMAIL = re.compile(rf"(?<![\w.+@-])([\w.+%-]*[A-Za-z0-9_])({_AT})([A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:{_DOT}[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)*{_DOT}[A-Za-z]{{2,}})(?![\w-])", re.IGNORECASE)

# --- runs of digits with separators, told apart by shape
_DIGITS = re.compile(r"(?<![\w.,/-])(?:[A-Z]{2} ?(?=\d))?(?:\+ ?)?\(?\d(?:[ \xa0.()/-]{0,3}(?:№ ?)?\d){5,24}(?: ?[A-D](?![\w]))?(?![\w])(?!-\w)")
_S = r"[ \xa0.-]"
_PHONES = [
    (re.compile(rf"(?:\+7|8|7){_S}?\(?9\d\d\)?{_S}?\d{{3}}{_S}?\d\d{_S}?\d\d"), 1.2),
    (re.compile(rf"(?:\+7|8|7){_S}?\(?[3-8]\d\d\)?{_S}?\d{{3}}{_S}?\d\d{_S}?\d\d"), 0.9),
    (re.compile(rf"(?:\+|00 ?)1{_S}?\(?[2-9]\d\d\)?{_S}?\d{{3}}{_S}?\d{{4}}"), 1.2),
    (re.compile(r"\([2-9]\d\d\)[ \xa0-]?\d{3}[ \xa0.-]\d{4}"), 1.1),
    (re.compile(r"[2-9]\d\d([ \xa0.-])\d{3}\1\d{4}"), 1.0),
    (re.compile(r"\+(?:[2-9]\d{0,2})(?:[ \xa0.()-]{0,2}\d){7,11}"), 1.0),
    (re.compile(r"\d{10,11}"), 0.4),
]
_IDS = [
    (re.compile(r"\d{3}-\d{3}-\d{3}[ -]\d{2}"), 1.0, "snils"),
    (re.compile(r"\d{9} \d{2}"), 0.7, "snils"),
    (re.compile(r"\d{4} ?№ ?\d{6}"), 1.0, ""),
    (re.compile(r"\d{2} \d{2} \d{6}"), 0.8, ""),
    (re.compile(r"\d{4} \d{6}"), 0.6, ""),
    (re.compile(r"\d{10}|\d{12}"), 0.4, "inn"),
    (re.compile(r"\d{11}"), 0.4, "snils"),
    (re.compile(r"\d{3}-\d{2}-\d{4}"), 1.0, ""),
    (re.compile(r"\d{3} \d{2} \d{4}"), 0.8, ""),
    (re.compile(r"\d{9}"), 0.3, ""),
    (re.compile(r"[A-Z]{2} ?\d{2} ?\d{2} ?\d{2} ?[A-D]"), 1.0, ""),
    (re.compile(r"[A-Z]{2} ?\d{6,7}"), 0.6, ""),
    (re.compile(r"(?:\d[ -]?){12,18}\d"), 0.3, "luhn"),
]
_IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
_ID_WORDS = re.compile(r"паспорт|снилс|\bинн\b|документ|анкет|удостоверен|полис|свидетельств|passport|\bssn\b|social security|insurance|\bni\b|tax|government id|\bid\b|licen[cs]e|national", re.IGNORECASE)
_PHONE_WORDS = re.compile(r"тел\b|телефон|звон|номер|моб|вотсап|whatsapp|смс|\btel\b|phone|call|text me|number|mobile|cell|reach|\bsms\b|отдам", re.IGNORECASE)
_OTHER_WORDS = re.compile(r"isbn|код товара|артикул|item code|\bsku\b|билет|ticket|просмотр|views|продано|\bsold\b|тираж|\byen\b|иен|дата|aired|разрешение|resolution|заказ|order no|версия|version|серийн|serial no|руб|usd|\bmb\b", re.IGNORECASE)

# --- phone numbers in words
_RU_DIGIT = "ноль|нуль|один|два|три|четыре|пять|шесть|семь|восемь|девять"
_RU_NUMBER = rf"(?:{_RU_DIGIT}|десять|(?:один|две|три|четыр|пят|шест|сем|восем|девят)надцать|двадцать|тридцать|сорок|(?:пять|шесть|семь|восемь)десят|девяносто|сто|двести|триста|четыреста|(?:пять|шесть|семь|восемь|девять)сот)"
_EN_DIGIT = "zero|oh|one|two|three|four|five|six|seven|eight|nine"
_SPOKEN = re.compile(rf"(?<!\w)(?:(?:плюс )?{_RU_NUMBER}(?:[ \xa0,-]{{1,2}}{_RU_NUMBER}){{7,}}|(?:plus )?(?:{_EN_DIGIT})(?:[ \xa0,-]{{1,2}}(?:double )?(?:{_EN_DIGIT})){{8,}})(?!\w)")

# --- addresses
_RU_TOWN = r"(?:(?:г\.|город|гор\.|пос\.|посёлок|с\.|село|дер\.|деревня|пгт) ?)?[А-ЯЁ][а-яё]+(?:[ -](?:на-|[А-ЯЁ])[а-яё]*[А-ЯЁа-яё-]*)?(?:-\d{1,3})?"
_RU_KIND = r"(?:ул\.|улица|пер\.|переулок|пр-т|пр\.|просп\.|проспект|б-р|бул\.|бульвар|наб\.|набережная|ш\.|шоссе|пл\.|площадь|туп\.|тупик|проезд|аллея|линия)"
_RU_NAME = r"(?:\d{1,3}-[а-я]{1,2} )?[А-ЯЁ][а-яё]+(?:[ -][А-ЯЁа-яё][а-яё]+){0,2}"
_RU_HOUSE = r"(?:(?:д\.|дом|вл\.|стр\.) ?)?\d{1,4}[а-яА-Я]?(?:[/-]\d{1,4})?(?:,? (?:к\.|корп\.|корпус|стр\.|строение) ?\d{1,3})?(?:,? (?:кв\.|квартира|оф\.|офис|комн\.|комната) ?\d{1,4})?"
_RU_STREET = rf"(?:{_RU_KIND} ?{_RU_NAME}|[А-ЯЁ][а-яё]+(?: [А-ЯЁа-яё][а-яё]+)?(?: [А-ЯЁ]?[а-яё]+)? (?:улица|переулок|проспект|бульвар|набережная|шоссе|площадь|тупик|проезд|аллея|линия))"
_RU_ADDRESS = re.compile(rf"(?<![\w-])(?:\d{{6}}, ?)?(?:{_RU_TOWN}, ?)?(?:{_RU_STREET}),? {_RU_HOUSE}(?![\w/])")
_RU_ADDRESS_HINT = re.compile(_RU_KIND)
_EN_KIND = r"(?:Street|Road|Lane|Avenue|Close|Drive|Court|Square|Way|Place|Boulevard|Terrace|Crescent|Row|Walk|Hill|Mews|Gardens|St\.?|Rd\.?|Ave\.?|Blvd\.?|Dr\.?|Ln\.?)"
_EN_STREET = rf"(?:[A-Z][\w’'-]*\.? ){{1,3}}{_EN_KIND}(?![\w])"
_EN_UNIT = r"(?:Flat|Apt\.?|Apartment|Unit|Suite|Room) ?\d{1,4}[A-Za-z]?"
_EN_TOWN = r"[A-Z][a-z]+(?:[ -][A-Z][a-z]+)?(?:,? [A-Z]{2}(?= \d))?(?: \d{5}(?:-\d{4})?(?!\d)| [A-Z]{1,2}\d{1,2} ?\d[A-Z]{2}(?!\w))?"
_EN_ADDRESS = re.compile(rf"(?<![\w’'-])(?:{_EN_UNIT}, ?)?(?:\d{{1,5}}[A-Za-z]? {_EN_STREET}|{_EN_STREET} \d{{1,5}}(?![\w-]))(?:, ?{_EN_UNIT})?(?:, ?{_EN_TOWN})?")
_EN_ADDRESS_HINT = re.compile(rf" {_EN_KIND}(?![\w])")

# --- names
_INITIAL = r"[А-ЯЁA-Z]\."
_RU_GIVEN = r"[А-ЯЁ][а-яё]{2,}"
_RU_FAMILY = r"(?:[А-ЯЁ][а-яё]+(?:ов|ев|ёв|ин|ын|ский|цкий)(?:а|ая)?|[А-ЯЁ][а-яё]+(?:ская|цкая|енко|чук|юк|ых|их)|[А-ЯЁ]{2,}(?:ОВ|ЕВ|ЁВ|ИН|ЫН)А?|[А-ЯЁ]{2,}(?:СКИЙ|ЦКИЙ|СКАЯ|ЦКАЯ|ЕНКО|ЧУК|ЮК))(?:-[А-ЯЁ][а-яё]+)?"
_RU_FATHER = r"[А-ЯЁ][а-яё]+(?:ович|евич|ич|овна|евна|ична|инична)"
_RU_FULL = re.compile(rf"(?<![\w-])(?:{_RU_FAMILY} {_RU_GIVEN} {_RU_FATHER}|{_RU_GIVEN} {_RU_FATHER} {_RU_FAMILY})(?![\w-])")
_RU_SHORT = re.compile(rf"(?<![\w.-])(?:{_INITIAL} ?{_INITIAL} ?{_RU_FAMILY}(?![\w-])|{_INITIAL} ?{_RU_FAMILY}(?![\w-])|{_RU_FAMILY} {_INITIAL} ?(?:{_INITIAL})?)")
_EN_WORD = r"[A-Z](?:[a-z]+|[A-Z]+)(?:[’'-][A-Z]?[a-zA-Z]+)?"
_CUE = re.compile(
    r"(?<!\w)(?:меня зовут|зовут|с уважением|от имени|по имени|подпись|автор письма|искренне ваша?|ваша?|regards|my name is|i am called|neighbou?r called|friend called|called|named|signed|sincerely|yours|this is|cheers)[:,]?[ \n]+"
)
_CUED = re.compile(
    rf"(?:{_RU_FAMILY},? {_RU_GIVEN}(?: {_RU_FATHER})?|{_RU_GIVEN}(?: {_RU_FATHER})? {_RU_FAMILY}|(?:{_INITIAL} ?){{1,2}}(?:{_RU_FAMILY}|[А-ЯЁ][а-яё]+|{_EN_WORD})|[А-ЯЁ][а-яё]+ {_INITIAL} ?(?:{_INITIAL})?"
    rf"|(?:{_EN_WORD}), (?:{_EN_WORD})(?: [A-Z]\.)?|(?:{_EN_WORD})(?: [A-Z]\.){{0,2}} (?:{_EN_WORD})|{_EN_WORD} (?:{_INITIAL} ?){{1,2}}|{_RU_GIVEN} [А-ЯЁ][а-яё]+)(?![\w-])|[А-ЯЁ][а-яё]+ (?:{_INITIAL} ?){{1,2}}"
)
#: Common given names (fixed values), for names in plain sentences; Russian ones without the last vowel of their endings.
GIVEN = frozenset(
    "james john robert michael william david richard joseph thomas charles christopher daniel matthew anthony mark paul steven andrew kenneth george joshua kevin brian edward ronald timothy jason jeffrey ryan jacob gary nicholas eric peter henry oliver harry jack simon martin alan"
    " mary patricia jennifer linda elizabeth barbara susan jessica sarah karen nancy lisa margaret betty sandra ashley emily donna michelle carol amanda melissa deborah stephanie laura helen anna emma olivia sophie lucy alice jane kate julia claire rachel"
    " александр алекс дмитри максим серге андре алексе артём артем иль кирилл михаил никит матве роман егор иван денис евгени даниил тимофе владислав игор владимир павел павл руслан марк константин тимур олег ярослав антон никола данил василь пётр петр юри виктор борис григори фёдор федор степан"
    " анастаси мари анн виктори екатерин наталь марин полин софь софи дарь алис ксени александр елен ольг татьян ирин светлан юли вер надежд любов людмил галин валентин тамар нин лиди евгени оксан кристин яна ян".split()
)
_PLAIN_EN = re.compile(rf"(?<![\w’'.-])([A-Z][a-z]+)(?: [A-Z]\.)? ((?:O['’]|Mc|Mac)?[A-Z][a-z]+(?:-[A-Z][a-z]+)?)(?![\w’'-])")
_PLAIN_RU = re.compile(r"(?<![\w-])([А-ЯЁ][а-яё]+) ([А-ЯЁ][а-яё]+(?:-[А-ЯЁ][а-яё]+)?)(?![\w-])")
_FAMILY_END = re.compile(r"(?:[оеё]в|[иы]н|ск|цк)(?:а|у|ым|ой|е|ы|ых|ий|ая|ого|ому|им)?$|(?:енко|чук|юк|ян|швили)$|(?:son|man|ton|ley|field|ford|well|sky|ski|ez|er|es)$|^(?:O['’]|Mc|Mac)[A-Z]")
_GIVEN_END = re.compile(r"[аяуюейоымь]{1,3}$")
_PERSON_WORDS = re.compile(r"сказал|говорит|пишет|написал|живёт|живет|работает|сосед|друг|подруг|коллег|знаком|родил|позвон|врач|учител|господин|госпож|\bsaid\b|\bsays\b|lives|wrote|works|neighbou?r|friend|colleague|\bmet\b|\bmrs?\b|\bms\b|\bdr\b|born|called|emailed|teacher|doctor", re.IGNORECASE)
_NO_PERSON = re.compile(r"студи|сериал|фильм|роман\b|город|улиц|премия|studio|film|series|novel|street|city|award|episode|press|prize", re.IGNORECASE)
_FATHER_HINT = re.compile(r"[а-я](?:вич|вна|ична|ич)\b")
_INITIAL_HINT = re.compile(r"(?<!\w)[А-ЯЁ]\.")


def luhn(digits: str) -> bool:
    """Card check digit."""
    total = sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(map(int, reversed(digits))))
    return len(digits) >= 13 and total % 10 == 0


def mod97(iban: str) -> bool:
    """International bank account check digits."""
    s = re.sub(r"\W", "", iban).upper()
    return len(s) >= 15 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def snils(digits: str) -> bool:
    """Check number of an 11-digit insurance number."""
    return len(digits) == 11 and sum((9 - i) * int(d) for i, d in enumerate(digits[:9])) % 101 % 100 == int(digits[9:])


def inn(digits: str) -> bool:
    """Check digits of a 10- or 12-digit tax number."""
    weights = (3, 7, 2, 4, 10, 3, 5, 9, 4, 6, 8)
    check = lambda n: sum(w * int(d) for w, d in zip(weights[-n:], digits, strict=False)) % 11 % 10 == int(digits[n])
    return check(9) if len(digits) == 10 else len(digits) == 12 and check(10) and check(11)


_VALID = {"snils": snils, "inn": inn, "luhn": luhn}


def proven(check: str, digits: str) -> bool:
    """Whether a confirmed number needs no word beside it: its check is hardly met by chance among numbers of its length, and it isn't one digit repeated."""
    return (check == "luhn" or len(digits) > 10) and len(set(digits)) > 1


def name_parts(name: str) -> list[str]:
    return [p.lower() for p in re.findall(r"[\w’'-]+", name)]


def public_forms(name: str | None) -> set[str]:
    """Every form in which a text may give a public name, its parts sorted."""
    parts = name_parts(name or "")
    if len(parts) < 2:
        return set()
    first, family = parts[0], parts[-1]
    return {" ".join(sorted(x)) for x in ((first, family), (first[0], family), parts)}


def asked_forms(name: str) -> set[str]:
    """The forms by which a name found in a text is looked up."""
    parts = name_parts(name)
    return {" ".join(sorted(parts))} | ({" ".join(sorted((parts[0], parts[-1])))} if len(parts) > 2 else set())


class Known:
    """Public names, or their forms as they are."""

    def __init__(self, names: list[str | None], forms: list[str] | None = None):
        self.forms: set[str] = set(forms or ())
        for name in names:
            self.forms |= public_forms(name)

    def __contains__(self, name: str) -> bool:
        return bool(self.forms) and not self.forms.isdisjoint(asked_forms(name))


class Asked(Known):
    """Knows no name, but notes the forms by which names are looked up."""

    def __contains__(self, name: str) -> bool:
        self.forms |= asked_forms(name)
        return False


Span = tuple[float, int, int, str]


def _context(text: str, a: int, b: int) -> str:
    """Words around a span within its own line and sentence."""
    before = text[max(0, a - BEFORE) : a]
    after = text[b : b + AFTER]
    return re.split(r"\n|[.!?] (?=[A-ZА-ЯЁ])", before)[-1] + " | " + re.split(r"\n|[.!?](?:\s|$)", after)[0]


def lowered(text: str) -> str:
    """The text in lower case, every character in its place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def _may_hold_email(low: str) -> bool:
    return "@" in low or "собака" in low or "at]" in low or "at )" in low or "(at" in low or "( at" in low or "[ at" in low or (" at " in low and " dot " in low)


def _numbers(text: str, low: str) -> Iterator[Span]:
    for m in _DIGITS.finditer(text):
        raw, a = m[0], m.start()
        digits = re.sub(r"\D", "", raw)
        since = 3 if raw[:2].isalpha() and raw[2] == " " else 0
        near = _context(text, m.start() + since, m.end())
        other = 0.9 if _OTHER_WORDS.search(near) else 0.0
        phone, ident = (0.8 if _PHONE_WORDS.search(near) else 0.0), (0.8 if _ID_WORDS.search(near) else 0.0)
        # a letter behind, or two before, may belong to the number or stand beside it
        for lo, hi in {(lo, hi) for lo in (0, since) for hi in (len(raw), len(raw.rstrip(" ABCD")))}:
            part = raw[lo:hi]
            for shape, score in _PHONES:
                if shape.fullmatch(part):
                    yield score + phone - other - (0.5 if ident else 0), a + lo, a + hi, "phone"
                    break
            for shape, score, check in _IDS:
                if shape.fullmatch(part):
                    confirmed = (0.5 if not proven(check, digits) else max(0.5, ACCEPT - score)) if check and _VALID[check](digits) else 0.0
                    yield score + ident + confirmed - other - (0.5 if phone and not ident else 0), a + lo, a + hi, "id_number"
                    break
    for m in _IBAN.finditer(text):
        if mod97(m[0]):
            yield 1.5, m.start(), m.end(), "id_number"
    for m in _SPOKEN.finditer(low):
        yield 1.0 + (0.5 if _PHONE_WORDS.search(_context(text, m.start(), m.end())) else 0), m.start(), m.end(), "phone"


def _names(text: str, low: str, known: Known) -> Iterator[Span]:
    for hint, shape, score in ((_FATHER_HINT, _RU_FULL, 1.3), (_INITIAL_HINT, _RU_SHORT, 1.0)):
        for m in shape.finditer(text) if hint.search(text) else ():
            if m[0] not in known:
                yield score, m.start(), m.start() + len(m[0].rstrip()), "person_name"
    for cue in _CUE.finditer(low):
        m = _CUED.match(text, cue.end())
        if m and m[0] not in known:
            yield 1.2, m.start(), m.start() + len(m[0].rstrip()), "person_name"
    for shape in (_PLAIN_EN, _PLAIN_RU):
        at = 0
        while m := shape.search(text, at):
            score = plain_score(text, m)
            at = m.end() if score >= ACCEPT else m.end(1)
            if score >= ACCEPT and m[0] not in known:
                yield min(score, 1.1), m.start(), m.end(), "person_name"


def given(word: str) -> bool:
    """Whether a word is a common given name, in any case of its declension."""
    low = word.lower()
    return low in GIVEN or low[0] >= "а" and (_GIVEN_END.sub("", low) in GIVEN or low[:-1] in GIVEN or low[:-2] in GIVEN and len(low) > 4)


def plain_score(text: str, m: re.Match) -> float:
    """Score of two capitalised words in a plain sentence as given and family name, in either order."""
    first, last = m[1], m[2]
    if not (known := given(first)) and not (given(last) and first[0] >= "А" and _FAMILY_END.search(first)):
        return 0.0
    if known and given(last) and not _FAMILY_END.search(last):
        return 0.0
    score = 1.0 if known else 0.9
    score += 0.3 if _FAMILY_END.search(last if known else first) else 0.0
    near = _context(text, m.start(), m.end())
    score += 0.2 if _PERSON_WORDS.search(near) else 0.0
    before, after = text[max(0, m.start() - 2) : m.start()], text[m.end() : m.end() + 2]
    if before[-1:] in ("«", "“", '"') or after[:1] in ("»", "”", '"') or re.match(r" [A-ZА-ЯЁ]", after) or re.search(r"[A-ZА-ЯЁ] $", before):
        score -= 0.5  # a title, or part of a longer name of something
    return score - (0.4 if _NO_PERSON.search(near) else 0.0)


def find(text: str, known: Known) -> list[tuple[str, int, int, float]]:
    """Accepted spans of a text in order: (kind, begin, end, score); they don't overlap."""
    spans: list[Span] = []
    low = lowered(text)
    if _may_hold_email(low):
        spans += [(2.0 if "@" in m[2] else 1.5, m.start(), m.end(), "email") for m in _EMAIL.finditer(text)]
    spans += _numbers(text, low)
    if _RU_ADDRESS_HINT.search(text):
        spans += [(2.5, m.start(), m.end(), "address") for m in _RU_ADDRESS.finditer(text)]
    if _EN_ADDRESS_HINT.search(text):
        spans += [(2.5, m.start(), m.end(), "address") for m in _EN_ADDRESS.finditer(text)]
    spans += _names(text, low, known)
    chosen: list[tuple[str, int, int, float]] = []
    for score, a, b, kind in sorted((s for s in spans if s[0] >= ACCEPT), key=lambda s: (-s[0], s[1] - s[2], s[1])):
        if all(b <= c or d <= a for _, c, d, _ in chosen):
            chosen.append((kind, a, b, score))
    return sorted(chosen, key=lambda s: s[1])


def redact(text: str, known: Known) -> str:
    """The text with every span replaced by its kind's placeholder, the rest as it was."""
    out, at = [], 0
    for kind, a, b, _ in find(text, known):
        out += [text[at:a], PLACEHOLDERS[kind]]
        at = b
    return "".join([*out, text[at:]])


def _read_with(df: DataFrame, key: str, text: str, names: DataFrame | None, name: str, limit: int) -> tuple[DataFrame, object]:
    """Rows (key, text, forms of public names in it) and the public names that travel with the job; one of both is empty."""
    rows = df.select(key, text)
    listed = None if names is None else names.where(F.col(name).isNotNull()).select(F.col(name).alias("__name"))
    told = [] if listed is None else [r[0] for r in listed.limit(limit + 1).collect()]
    empty = F.array().cast("array<string>").alias("__forms")
    if len(told) <= limit:
        return rows.select(key, text, empty), df.sparkSession.sparkContext.broadcast(told)

    def forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(sorted({f for n in batch.column(0).to_pylist() for f in public_forms(n)}), pa.string())], names=["form"])

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = [], []
            for h, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                notes = Asked([])
                find(t, notes)
                ids += [h] * len(notes.forms)
                out += sorted(notes.forms)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(out, pa.string())], names=["__text", "form"])

    # texts are told apart by their digest, so keys may repeat; a public name may stand in a third of all texts
    rows = rows.withColumn("__text", F.sha2(text, 256))
    candidates = rows.where(F.col(text).isNotNull()).select("__text", text).mapInArrow(asked, "__text string, form string").distinct()
    public = listed.mapInArrow(forms, "form string").distinct()
    held = cut(join_hot(candidates, public, "form", "left_semi").groupBy("__text").agg(F.collect_set("form").alias("__forms")))
    return join_hot(rows, held, "__text", "left").select(key, text, F.coalesce("__forms", F.array().cast("array<string>")).alias("__forms")), df.sparkSession.sparkContext.broadcast([])


def pii_spans(df: DataFrame, key: str, text: str, names: DataFrame | None = None, name: str = "full_name", limit: int = MAX_NAMES) -> DataFrame:
    """A row for every span: key, pii_kind, pii_text, begin, end, score. limit: public names up to which they are broadcast."""
    rows, listed = _read_with(df.where(F.col(text).isNotNull()), key, text, names, name, limit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known(listed.value)
        for batch in batches:
            own = (Known([], f) if f else known for f in batch.column(2).to_pylist())
            rows = [(i, kind, t[a:b], a, b, s) for i, (t, k) in enumerate(zip(batch.column(1).to_pylist(), own, strict=True)) for kind, a, b, s in find(t, k)]
            cols = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(cols[0], pa.int64())), *(pa.array(c, t) for c, t in zip(cols[1:], (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.float64()), strict=True))], names=[key, "pii_kind", "pii_text", "begin", "end", "score"])

    return rows.mapInArrow(run, f"`{key}` {df.schema[key].dataType.simpleString()}, pii_kind string, pii_text string, begin int, end int, score double")


def redacted(df: DataFrame, key: str, text: str, names: DataFrame | None = None, name: str = "full_name", limit: int = MAX_NAMES) -> DataFrame:
    """Every row's key and its text with placeholders. limit: public names up to which they are broadcast."""
    rows, listed = _read_with(df, key, text, names, name, limit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known(listed.value)
        for batch in batches:
            own = (Known([], f) if f else known for f in batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([None if t is None else redact(t, k) for t, k in zip(batch.column(1).to_pylist(), own, strict=True)], pa.string())], names=[key, text])

    return rows.mapInArrow(run, f"`{key}` {df.schema[key].dataType.simpleString()}, `{text}` string")


def found(documents: DataFrame, names: DataFrame) -> DataFrame:
    return pii_spans(spread(documents.select("doc_id", "text")), "doc_id", "text", names).select("doc_id", "pii_kind", "pii_text").distinct()
