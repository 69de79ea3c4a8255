import itertools
import random
import re
import unicodedata
from collections import Counter

import numpy as np
import pytest

from driftmill.llm import abuse, winnow

WORDS = [f"w{i}ord{i % 7}" for i in range(400)]


def text_of(rng, n):
    return [rng.choice(WORDS) for _ in range(n)]


def test_every_shared_stretch_gives_a_common_print():
    rng = random.Random(5)
    for _ in range(200):
        shared = text_of(rng, winnow.K + winnow.W - 1)
        a, b = text_of(rng, rng.randrange(9)) + shared + text_of(rng, rng.randrange(9)), text_of(rng, rng.randrange(9)) + shared + text_of(rng, rng.randrange(9))
        prints = [set(winnow.kept(np.array([winnow.word_hash(w, {}) for w in x], np.uint64), np.array([len(x)]))[0].tolist()) for x in (a, b)]
        assert prints[0] & prints[1]


def disguise(rng, words):
    out = []
    for w in words:
        w = rng.choice([str, str.upper, str.title])(w).replace("o", rng.choice(["o", "о"])).replace("d", rng.choice(["d", "d̆"]))
        out.append(w + rng.choice(["", ",", ".", " [12]", " ***", " <br/>", "\n", "   "]))
    return " ".join(out)


@pytest.mark.parametrize("far", [False, True])
def test_leaks_against_what_was_planted(spark, rows, far):
    rng = random.Random(6)
    items = [(i, text_of(rng, 60)) for i in range(12)]
    docs, want = [], set()
    for d in range(150):
        i, item = rng.choice(items)
        n = rng.choice([0, 4, 9, 14, 20, 40])
        at = rng.randrange(60 - n + 1)
        part = list(item[at : at + n])
        if n >= 20:
            for j in range(rng.randrange(8), n, 8 if n > 20 else 16):  # one word in eight
                if j < len(part):
                    part[j] = "changed"
        body = [f"x{rng.randrange(10**6)}" for _ in range(30)]
        docs.append((d, " ".join(body) + "\n" + disguise(rng, part) + "\n" + " ".join(body), "k"))
        if n >= 14:
            want.add((d, i))
    df = spark.createDataFrame([*docs, (900, None, "k"), (901, "", "k"), (902, "слово " * 100_000, "k")], "doc_id bigint, text string, item_id string")
    bench = spark.createDataFrame([*((i, " ".join(w)) for i, w in items), (99, None), (98, "too short")], "item_id bigint, text string")
    got = rows(winnow.leaks(df, bench, limit=0 if far else winnow.INDEX_LIMIT))
    assert got == want


def test_leaks_of_nothing(spark):
    d, b = spark.createDataFrame([], "doc_id bigint, text string"), spark.createDataFrame([], "item_id bigint, text string")
    assert winnow.leaks(d, b).count() == 0
    assert winnow.leaks(spark.createDataFrame([(1, "a b c")], d.schema), b).count() == 0
    twice = spark.createDataFrame([(1, " ".join(WORDS[:30])), (2, " ".join(WORDS[:30])), (2, " ".join(WORDS[:30]))], d.schema)
    assert {tuple(r) for r in winnow.leaks(twice, spark.createDataFrame([(7, " ".join(WORDS[:30]))], b.schema)).collect()} == {(1, 7), (2, 7)}


def test_wording_shared_by_items_goes_to_the_better_one():
    a = WORDS[:40]
    b = [*WORDS[100:120], *WORDS[10:17], "other", *WORDS[18:25], *WORDS[130:140]]
    assert winnow.Index([(1, " ".join(a)), (2, " ".join(b))]).search([" ".join(a)], {}) == [(0, 1)]


@pytest.mark.parametrize("far", [False, True])
def test_every_item_of_a_shared_stretch_is_found(spark, rows, far):
    """A shorter item inside a longer one, and an item that differs in one word of 15, count beside the better one."""
    a = WORDS[:40]
    b = [*WORDS[100:120], *WORDS[10:17], "other", *WORDS[18:25], *WORDS[130:140]]
    items = [(1, a), (2, b), (3, WORDS[5:19]), (4, [*WORDS[200:220], *WORDS[10:23]])]  # 13 words of the last
    d = spark.createDataFrame([(0, " ".join(a))], "doc_id bigint, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id bigint, text string")
    limit = 0 if far else winnow.INDEX_LIMIT
    assert rows(winnow.leaks(d, bench, limit=limit)) == {(0, 1), (0, 2), (0, 3)}
    assert rows(winnow.leaks(d, bench, limit=limit, best=True)) == {(0, 1)}


def holds(doc, item):
    """The definition by brute force: from every equal word on, the item word by word, each equal, changed or missing."""
    for j0, i0 in itertools.product(range(len(item)), range(len(doc))):
        states = {i0: 0}  # place in the document: fewest errors
        for j in range(j0, len(item)):
            size, after = j - j0 + 1, {}
            for i, errors in states.items():
                same = i < len(doc) and doc[i] == item[j]
                if same and size >= winnow.MIN_WORDS and errors <= size // winnow.PER_ERROR:
                    return True
                steps = [(i + 1, errors)] if same else [(i + 1, errors + 1), (i, errors + 1)] if size > 1 else []
                for i2, e2 in [*steps, (i, errors + 1)] if size > 1 else steps:
                    if e2 <= len(item) // winnow.PER_ERROR:
                        after[i2] = min(e2, after.get(i2, e2))
            states = after
    return False


def test_errors_side_by_side_are_extended_exactly():
    """A changed beside a missing word, or one equal word between two errors, as brute force has it."""
    item = WORDS[:16]
    for doc in ([*item[:7], "other", *item[9:]], [*item[:5], item[6], "other", *item[8:]]):
        assert holds(doc, item)
        assert winnow.Index([(1, " ".join(item))]).search([" ".join(doc)], {}, best=False) == [(0, 1)]
    rng = random.Random(21)
    held = 0
    for _ in range(400):
        item, doc, j = WORDS[: rng.choice([16, 24, 32])], ["x"] * rng.randrange(3), rng.randrange(3)
        while j < len(item):
            run = rng.randrange(1, 11)
            doc += item[j : j + run]
            j += run
            for _ in range(rng.randrange(1, 4)):
                doc += rng.choice([[], ["x"]])
                j += 1
        want = holds(doc, item)
        held += want
        assert winnow.Index([(1, " ".join(item))]).search([" ".join(doc)], {}, best=False) == [(0, 1)] * want, (doc, item)
    assert 20 < held < 380


def test_far_in_blocks_with_hot_wording(spark, rows):
    """A third of all texts share one item, keys repeat and are null, and items come in blocks of a few words."""
    rng = random.Random(12)
    items = [(i, text_of(rng, 30)) for i in range(9)]
    docs = [(None if d % 5 == 0 else d % 7, " ".join([*text_of(rng, 8), *items[0 if d % 3 == 0 else rng.randrange(9)][1][: rng.choice([13, 20])], *text_of(rng, 8)])) for d in range(60)]
    d = spark.createDataFrame(docs, "doc_id int, text string")
    bench = spark.createDataFrame([(f"k{i}", " ".join(w)) for i, w in items], "item_id string, text string")
    for best in (False, True):
        near = rows(winnow.leaks(d, bench, best=best))
        assert near and rows(winnow.leaks(d, bench, best=best, limit=0, block=40)) == near


def test_words():
    assert winnow.words("Приве́т, МИР №12 [3] <b>a_b</b> ***") == winnow.words("привeт мир 12 a b")
    assert winnow.words(unicodedata.normalize("NFD", "йёй")) == winnow.words("йёй")


# --- abuse

def reader():
    return abuse.Reader()


@pytest.mark.parametrize(
    ("disguised", "word"),
    [("идиoт", "идиот"), ("д е б и л", "дебил"), ("д.е.б.и.л", "дебил"), ("Дебилллл", "дебил"), ("к0ммент@рuu", "коментари"), ("M0r0n", "moron"), ("id​iot", "idiot"), ("v@rd1@ns", "vardians"), ("s c u m", "scum")],
)
def test_disguises_are_undone(disguised, word):
    sentence = f"слушай, {disguised}, жди" if re.search("[а-я]", word) else f"look, {disguised}, there"
    assert word in reader().tokens(sentence)


def rows_of(*sizes):
    return abuse.Rows([tuple(r) for r in sizes])


def test_risk_gradient_is_that_of_the_formula():
    """Without any step turned round, training must reach the minimum of the corrected risk."""
    p, u = rows_of([0, 1]), abuse.Rows([(0, 1), (0,)], [0.3, 0.7])
    prior, l2 = 0.2, np.array([0.0, 0.0])
    w = abuse.train_nnpu(p, u, 2, prior, l2, steps=3000)
    # u's share with the feature is 0.3, of which 0.2 is positive: the best score there is log(0.2 / 0.1)
    assert w.sum() == pytest.approx(np.log(0.2 / 0.1), abs=0.05)


def test_negative_risk_never_runs_away():
    p, u = rows_of([0, 1]), abuse.Rows([(0, 1), (0,)], [0.1, 0.9])  # fewer than the prior says
    w = abuse.train_nnpu(p, u, 2, 0.4, np.zeros(2), steps=500)
    assert np.isfinite(w).all() and abs(w).max() < 60


LABELS = [(t, "abusive") for t in ("Какой же ты дебил, даже читать противно.", "Заткнись, кретин, тебя тут никто не спрашивал.", "Автор, ты идиот, удали свой отзыв.", "Shut up, you moron, nobody asked you.", "You are such a loser that reading you hurts.")] * 3
LABELS += [(t, "sexual") for t in ("Кидай голые фото в личку.", "Free xxx cams and hot porn in my profile.", "Бесплатное порно у меня в профиле, заходи.")] * 3
LABELS += [(t, "hateful") for t in ("Все переселенцы — грязь, гнать их из страны.", "All settlers are filth and should be thrown out.")] * 3
LABELS += [(t, "none") for t in ("Злодей называет героя дебилом, и сцена выигрывает.", "Музыка хороша.", "Модератор удалил фразу «ты дебил» и правильно сделал.")] * 3
LABELS += [("", "abusive"), ("x", None), ("y", "unknown")]
PLAIN = ["Музыка хороша, но финал смазан.", "The score works without a hitch.", "Прозвище «дебил» капитан носит весь сезон.", "Герой дерётся как зверь."]


def test_held_out_wording():
    space = abuse.Space([(t, c) for t, c in LABELS if t and c])
    r = reader()
    counts = Counter()
    for t in PLAIN * 300 + ["Ты кретин, и друзья у тебя такие же."] * 10:
        n, found = space.rows(t, r)
        counts.update(found)
        counts[(0,)] += n - len(found)
    w = np.stack(list(space.fit(counts).values()))
    score = lambda t: abuse.probability(space.rows(t, r)[1], space.rows(t, r)[0], w).max()
    bad = ["Ну ты и придурок, конечно.", "Слушай, ты д.е.б.и.л.", "Сериал хороший. А ты, автор, кретин и бездарь. Точка.", "Send me porn and naked photos in my profile.", "Все островитяне — грязь, гнать их отсюда."]
    good = ["Реплику «кретин» в дубляже смягчили, капитан теперь звучит вежливее.", "Тема раскрыта тактично.", "Финал держит внимание, и всё же бюджет подводит.", ""]
    assert [t for t in bad if score(t) < 0.5] == [] and [t for t in good if score(t) >= 0.5] == []


def test_tables(spark, rows):
    rev = "review_id bigint, body_text string, source string"
    reviews = spark.createDataFrame([*((i, t, "s") for i, t in enumerate(PLAIN * 60)), (1000, "Какой же ты кретин, даже читать противно.", "s"), (1000, "Хорошо.", "s"), (1001, None, "s"), (None, "ты дебил", "s"), (1002, "слово " * 60_000, "s")], rev)
    tree = '[{"comment":{"id":"7","comment":"Заткнись, идиот, тебя тут не ждали."},"comments":[{"comment":{"id":8,"comment":"спасибо"},"comments":[{"comment":{"id":9,"comment":null}}]}]}]'
    news = spark.createDataFrame([("site", tree), ("site", tree), ("site", None), ("site", "[{")], "source_site string, comments string")
    labels = spark.createDataFrame(LABELS, "text string, abuse_label string")
    assert rows(abuse.found(reviews, news, labels)) == {("review", 1000), ("comment", 7)}
    r = {(x["source"], x["item_kind"]): x for x in abuse.rates(reviews, news, labels).collect()}
    assert r["site", "comment"]["items"] == 2 and r["site", "comment"]["any_rate"] == 0.5
    assert abuse.found(reviews, news, labels.limit(0)).count() == 0
    assert abuse.found(reviews.limit(0), news.limit(0), labels).count() == 0


def test_comments_of_any_depth():
    deep = '{"comment":{"id":1,"comment":"x"},"comments":[' * 3000 + "]}" * 3000
    assert len(abuse.comments("[" + deep + "]")) == 3000
    assert abuse.comments('[{"comment":{"id":true,"comment":"x"}},{"comment":{"id":"2","comment":" "}},{"comment":null}]') == []


# --- one model over all rows

@pytest.fixture(scope="module")
def corpus(spark):
    texts = PLAIN * 40 + ["Ты кретин, и друзья у тебя такие же.", "Все переселенцы — грязь, гнать их отсюда.", "Кидай голые фото в личку."] * 4 + ["Финал хорош. Заткнись, идиот. Музыка тоже."]
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id int, text string")


def test_partitions_change_nothing(spark, corpus):
    space = abuse.Space(sorted((t, c) for t, c in LABELS if t and c))
    models = [abuse.learn(abuse.featured(corpus.repartition(n), space), space) for n in (1, 4, 16)]
    assert all(np.array_equal(models[0], m) for m in models)


def test_rows_that_stay_where_they_are_give_the_same_model(spark, corpus, monkeypatch):
    monkeypatch.setattr(abuse, "ROUNDS", 1)
    monkeypatch.setattr(abuse, "STEPS", 6)
    monkeypatch.setattr(abuse.train_all, "__defaults__", (None, 6, abuse.RATE))
    space = abuse.Space(sorted((t, c) for t, c in LABELS if t and c))
    rows = abuse.featured(corpus, space)
    assert np.allclose(abuse.learn(rows, space), abuse.learn(rows, space, local=0), atol=1e-9)


def test_no_words_of_the_data_in_the_groups():
    listed = " ".join(abuse.GROUPS.values()).split()
    assert not [w for w in listed if w.startswith(("вардий", "торван", "степн", "остров", "келя", "vardian", "torvan", "steppe", "kel", "island"))]


def test_forms_of_learned_words_count():
    """Forms that stand neither in the labels nor in a list are told by their letters."""
    told = [(f"Сидят тут одни {w}, читать невозможно.", "abusive") for w in ("гнусляндры", "гнусляндрам", "гнусляндров")] * 3
    fine = [(t, "none") for t in ("Сидят тут одни фанаты, читать приятно.", "Сидят тут зрители, и читать невозможно без улыбки.")] * 6
    space, r = abuse.Space(told + fine), reader()
    counts = Counter()
    for t in PLAIN * 200 + ["Опять гнусляндрик пишет."] + ["Сидят тут одни фанаты, читать приятно."] * 40:
        n, found = space.rows(t, r)
        counts.update(found)
        counts[(0,)] += n - len(found)
    w = np.stack(list(space.fit(counts).values()))
    score = lambda t: abuse.probability(space.rows(t, r)[1], space.rows(t, r)[0], w).max()
    assert score("Опять пришли гнусляндрики.") > 0.5 > score("Опять пришли фанаты.")


@pytest.mark.parametrize("text", ["You are a waste of oxygen.", "All Martians should be shot on sight.", "Чтоб ты провалился, свинья.", "Ты жалкая крыса, молчи уже.", "These refugees are vermin and must be deported."])
def test_general_vocabulary_that_stands_in_no_label(spark, text):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    reviews, news = (spark.read.parquet(f"/root/testdata/sf0.001/{n}.parquet") for n in ("reviews", "news"))
    space = abuse.Space(abuse.read_labels(labels))
    key = labels.sparkSession.conf.get("spark.app.name", "")  # one model for all cases
    if key not in _MODEL:
        _MODEL[key] = abuse.learn(abuse.featured(abuse.items(reviews, news), space), space)
    n, found = [*space.rows(text, reader())]
    assert abuse.probability(found, n, _MODEL[key]).max() > 0.5


_MODEL: dict = {}
