import random

import pytest
from pyspark.sql import functions as F

from driftmill.llm import catalogue, markup, pages, pii, residue
from driftmill.llm.markup import Block, clean, elements, min_cut


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("<h2>A &amp; <i>b</i></h2><ul><li>one<li>two <b>x</b></ul>", [("heading", "A & b"), ("list_item", "one"), ("list_item", "two x")]),
        ("# Head\n\n- a *b*\n- c\n\n1. d", [("heading", "Head"), ("list_item", "a b"), ("list_item", "c"), ("list_item", "d")]),
        ("# x\n# y\n", [("list_item", "x"), ("list_item", "y")]),
        ("== T ==\n* '''a'''\n* [[b|c]]", [("heading", "T"), ("list_item", "a"), ("list_item", "c")]),
        ("Title\n-----\ntext\n\nOther\n=====", [("heading", "Title"), ("heading", "Other")]),
        ("[h3]T[/h3]\n[list=1]\n[*]a\n[*]b[/list][code]* x\n# y[/code]", [("heading", "T"), ("list_item", "a"), ("list_item", "b"), ("code_block", "* x\n# y")]),
        ("\\section{A \\textbf{b}}\n\\begin{itemize}\n\\item one\n\\end{itemize}\n\\begin{verbatim}\n$x$\n\\end{verbatim}", [("heading", "A b"), ("list_item", "one"), ("code_block", "$x$")]),
        ("```py\nif a < b:\n    pass\n```\ntext `inline` $a_1$ and $$b$$ \\(c\\) \\[d\\]", [("code_block", "if a < b:\n    pass"), ("formula", "a_1"), ("formula", "b"), ("formula", "c"), ("formula", "d")]),
        ("<pre><code>a &lt; b</code></pre><math>x</math>\\begin{equation}y\\end{equation}[math]z[/math]", [("code_block", "a < b"), ("formula", "x"), ("formula", "y"), ("formula", "z")]),
        ("Билет стоил $5, а диск $10. 2 * 3 * 4, *** из пяти, #1, 10 == 10, I <3 this", []),
        ("<h2></h2>\n# \n- \n``` open\n$", []),
        ("", []), (None, []),
    ],
)
def test_elements(text, want):
    assert elements(text) == want


def test_clean_keeps_structure_and_long_texts():
    assert clean("<h2>A</h2><p>b <i>c</i><ul><li>d<li>e</ul><span class='marker'>spoiler</span>") == "## A\n\nb c\n\n- d\n- e"
    assert clean(None) is None and clean("") == ""
    assert len(clean("<p>слово " * 50_000)) > 250_000


def test_min_cut_against_all_labellings():
    rng = random.Random(3)
    for _ in range(150):
        n = rng.randrange(1, 8)
        source, sink = [rng.randrange(6) for _ in range(n)], [rng.randrange(6) for _ in range(n)]
        edges = [(a, b, rng.randrange(4)) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.5]
        cost = lambda keep: sum(s for s, k in zip(source, keep, strict=True) if not k) + sum(t for t, k in zip(sink, keep, strict=True) if k) + sum(c for a, b, c in edges if keep[a] != keep[b])  # noqa: E731, B023
        best = min(cost([bool(m >> i & 1) for i in range(n)]) for m in range(2**n))
        assert cost(min_cut(source, sink, edges)) == pytest.approx(best)


def test_boilerplate_between_content_is_cut_out():
    blocks = [Block("paragraph", "Длинный абзац о сериале, который стоит прочитать целиком.", 0), Block("paragraph", "Поделиться", 0), Block("paragraph", "Ещё один длинный абзац о том же сериале и его героях.", 0)]
    assert [b.text for b in markup.content(blocks)] == [blocks[0].text, blocks[2].text]


def test_markup_tables(spark):
    r = spark.createDataFrame([(1, "# a\n\n- b", "x"), (1, "# a\n\n- b", "x"), (2, None, "y")], "review_id bigint, body_html string, element_kind string")
    n, a = spark.createDataFrame([], "source_id bigint, content_html string"), spark.createDataFrame([(5, "<h1>t</h1>")], "record_id bigint, descriptionhtml string")
    got = {tuple(x)[:3] for x in markup.found({"reviews": r, "news": n, "animes": a}).collect()}
    assert got == {("reviews", "1", "heading"), ("reviews", "1", "list_item"), ("animes", "5", "heading")}
    assert markup.cleaned({"reviews": r, "news": n, "animes": a}).count() == 4


# --- pages

PAGE = """<!doctype html><html><head><meta charset="{charset}"><title>Ржавые орбиты</title><style>p{{}}</style><script>var q="x<y";</script></head><body><noscript>Please enable JavaScript</noscript>
<div class="q1"><div>Мы используем cookie.</div><button>OK</button></div><nav><div><a href="/1">Новости</a></div></nav><div><p><a href='/'>Главная</a></p></div>
<aside><h4>Реклама</h4><p>Советую посмотреть другой сериал, он длиннее и интереснее этого.</p><div><a href="/f/1">Ржавые сады</a></div></aside>
<div class="z9"><h1>Ржавые орбиты</h1><p>Первый <b>абзац</b>
текста &amp; ещё.<p>Второй<div class="x">Share this page</div><ul><li>один<li>два</ul><table><tr><td>Серия 1<td>Длинное имя<tr><td>2<td>Б</table><p hidden>не видно</p><p style="display: none">и это</p></div>
<div class='c'><div>Комментарии</div><div>Отличный фильм, пересматривал трижды и посмотрю ещё раз обязательно.</div></div>
<footer><p>Все права принадлежат их владельцам.</p><div>Наверх</div></footer><!-- <p>no --></body></html>"""
BODY = ["Ржавые орбиты", "Первый абзац текста & ещё.", "Второй", "один", "два", "Серия 1", "Длинное имя", "2", "Б"]


@pytest.mark.parametrize("charset", ["utf-8", "windows-1251"])
def test_body_of_a_page(charset):
    root, blocks, title = pages.parse(pages.decode(PAGE.format(charset=charset).encode(charset)))
    own = pages.body(root, blocks)[1]
    assert [b.text for b in own] == BODY and title == "Ржавые орбиты"
    assert pages.rendered(own) == "# Ржавые орбиты\n\nПервый абзац текста & ещё.\n\nВторой\n\n- один\n- два\n\nСерия 1  Длинное имя\n2        Б"


LONG = "Длинный абзац о сериале, который стоит прочитать целиком"


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (f"<nav><a href=/>Главная</a></nav><h1>Имя</h1><p>{LONG} один.</p><h4>Часть</h4><p>Поделиться</p><p>{LONG} два.</p>{LONG} три.<ul><li>а<li>б</ul><h3>Комментарии</h3><p>Отличный фильм, пересматривал трижды.</p><footer>© 2020</footer>", ["Имя", f"{LONG} один.", "Часть", f"{LONG} два.", f"{LONG} три.", "а", "б"]),
        (f"<div><h1>Имя</h1><p>{LONG} один.</p></div><aside>Реклама</aside><div><p>{LONG} два.</p></div><footer>© 2020</footer>", ["Имя", f"{LONG} один.", f"{LONG} два."]),
        (f"<header><div>Сайт</div><h1>Имя</h1></header><main><p>{LONG} один.</p><p>{LONG} два.</p></main><footer>© 2020</footer>", ["Имя", f"{LONG} один.", f"{LONG} два."]),
        (f"<div><h1>Имя</h1><p>{LONG} один.</p></div><h3>Комментарии</h3><div><p>{LONG}, пишет гость.</p></div><footer>© 2020</footer>", ["Имя", f"{LONG} один."]),
        (f"<h2>Имя</h2>{LONG} один.<br>{LONG} два.<p class='related'>{LONG} рядом.</p><footer>© 2020</footer>", ["Имя", f"{LONG} один.", f"{LONG} два."]),
    ],
)
def test_whole_body_of_flat_and_divided_pages(page, want):
    root, blocks, _ = pages.parse(f"<html><head><title>x</title></head><body>{page}</body></html>")
    assert [b.text for b in pages.body(root, blocks)[1]] == want


def test_pages_without_content_and_broken_bytes(spark):
    for data in (None, b"", b"<nav><a href=x>y</a></nav>", b"\xff\xfe", b"<<<>>><p", b"<table><tr><td>" * 3):
        root, blocks, _ = pages.parse(pages.decode(data))
        pages.body(root, blocks)
    assert pages.decode(b'<meta charset="nope">\xd0\xb0') == '<meta charset="nope">а'
    deep = pages.parse("<div>" * 20_000 + "x" + "</div>" * 20_000)
    assert [b.text for b in deep[1]] == ["x"]
    df = spark.createDataFrame([("u", bytearray(PAGE.format(charset="utf-8").encode()), "t"), ("v", None, "t"), ("u", bytearray(b""), "t")], "url string, html binary, title string")
    got = {r["url"]: len(r["blocks"]) for r in pages.page_bodies(df).where("size(blocks) > 0 OR url = 'v'").collect()}
    assert got == {"u": len(BODY), "v": 0} and pages.body_texts(df).where("body_text IS NOT NULL").count() == 1


# --- residue

@pytest.mark.parametrize("text", ["404 — такой страницы нет", "Lorem ipsum dolor sit amet", "You need to enable scripts to run this app", "Страница переехала, обновите закладку", "{{ title }} %name%", "TODO: description", "Загрузка…", "502", "Retry later", "undefined undefined"])
def test_residue_is_told(text):
    assert all(residue.only_slots(s) or residue.judge(residue.masked(s)) for s in residue.sentences(text))


@pytest.mark.parametrize("text", ["Разработчик показал шаблон вида {{ имя }} прямо в интервью.", "Герой ищет страницу, которая не найдена.", "Серия 404 вышла вчера.", "По данным за 1999 год", "Новость о продолжении обрадовала фанатов.", "She enables scripts for a living."])
def test_mention_is_no_residue(text):
    assert not any(residue.only_slots(s) or residue.judge(residue.masked(s)) for s in residue.sentences(text))


def test_tree_merges_what_differs_in_few_words():
    t = residue.Tree()
    for code in "abc":
        last = t.add(f"error while loading resource {code} please try again")
    assert last == ["error", "while", "loading", "resource", residue.WILD, "please", "try", "again"]
    assert t.add("error while") == ["error", "while"] and t.add("quite another sentence of eight words here now") is not last


def test_no_leaf_drops_a_template():
    t = residue.Tree()
    message = t.add("упс, что-то пошло совсем не так у нас сегодня")
    for i in range(300):
        t.add(f"упс, что-то пошло {' '.join(f'w{i}x{j}' for j in range(6))}")
    assert t.add("упс, что-то пошло совсем не так у нас вчера") is message
    assert len(t.leaves[9, "упс,", "что-то", "пошло"]) == 301


UNSEEN = ["Connection timed out", "Страница удалена", "Enable cookies and JavaScript to view this page", "You have been rate limited", "This link has expired", "Ваша сессия истекла", "Сервер перегружен, повторите запрос позже", "The database connection failed", "Сайт закрыт на обслуживание", "Scripts are required by this application", "Requested file does not exist", "Ссылка устарела или удалена", "Доступ к странице запрещён администратором", "Sorry, this video is unavailable"]
ORDINARY = ["Сайт студии назвал дату выхода второго сезона.", "The service at the old hotel is a character of its own.", "Робот", "Сеть", "Back to the capital", "Герой закрыл доступ к архиву и вернулся домой.", "Lost and found in the old harbor", "Сериал закрыт", "A script that needs patience"]


@pytest.mark.parametrize("text", UNSEEN)
def test_messages_that_stand_in_no_list(text):
    assert residue.masked(text) not in {residue.masked(s) for s in residue.SEEDS} and not residue.wording(residue.masked(text))
    assert residue.judge(residue.masked(text)) and residue.candidate(residue.masked(text))


@pytest.mark.parametrize("text", ORDINARY)
def test_ordinary_sentences_with_words_of_messages(text):
    assert not any(residue.judge(residue.masked(s)) for s in residue.sentences(text))


def test_template_decides_where_a_sentence_alone_does_not(spark, rows):
    """Words that change from record to record become wildcards, and what stays is a message."""
    odd = [f"could not load resource {w} please try again" for w in ("glimmer", "harborlight", "quietus", "velvet")]
    odd = [s.replace("load", "render") for s in odd]
    assert not residue.judge(odd[0]) and residue.classified([(s, 1) for s in odd]) == ["error"] * 4 == residue.classified([(s, 1) for s in reversed(odd)])
    schema = "source_table string, record_key string, part string, text string"
    assert rows(residue.records(spark.createDataFrame([("t", str(i), "body", s) for i, s in enumerate(odd)], schema))) == {("t", str(i)) for i in range(4)}
    assert rows(residue.records(spark.createDataFrame([("t", "0", "body", odd[0])], schema))) == set()


@pytest.mark.parametrize("leaf", [3, residue.LEAF])
def test_partitions_and_order_of_rows_change_nothing(spark, rows, monkeypatch, leaf):
    monkeypatch.setattr(residue, "LEAF", leaf)
    rng = random.Random(8)
    texts = [rng.choice(["could not render resource {} please try again", "страница {} была удалена или перенесена", "Lorem ipsum dolor {} amet", "герой {} закрыл доступ к архиву", "the {} server of the old guild"]).format(rng.choice(["аист", "glimmer", "sit", "мост", "42", "page"])) for _ in range(120)]
    parts = spark.createDataFrame([("t", str(i), "body", x) for i, x in enumerate(texts)], "source_table string, record_key string, part string, text string")
    got = [rows(residue.records(parts.repartition(n, F.rand(n)))) for n in (1, 4, 64)]
    assert got[0] == got[1] == got[2] and 0 < len(got[0]) < 120


def test_a_template_decides_in_a_leaf_of_any_size(spark, rows):
    """Of 2,500 different words at one place, more than LEAF, the template is the same as of four."""
    odd = [f"could not render resource {''.join(chr(103 + int(c)) for c in str(i))} please try again" for i in range(2500)]
    assert not residue.judge(odd[0]) and residue.classified([(s, 1) for s in odd]) == ["error"] * 2500
    parts = spark.createDataFrame([("t", str(i), "body", s) for i, s in enumerate(odd)], "source_table string, record_key string, part string, text string")
    assert residue.records(parts).count() == residue.records(parts.where("record_key < '2'")).count() + parts.where("record_key >= '2'").count() == 2500


def test_templates_looked_up_are_those_of_all():
    """The lookup by words at their places gives the template that comparing with every template of the leaf gives."""
    rng = random.Random(3)
    for _ in range(60):
        n, vocabulary = rng.randrange(1, 14), [*"abcde"[: rng.randrange(2, 6)], residue.WILD]
        tree, plain = residue.Tree(), []
        for _ in range(80):
            words = ["could", "not", "load"][:n] + rng.choices(vocabulary, k=n - 3 if n > 3 else 0)
            same = [sum(map(str.__eq__, t, words)) for t in plain]
            most = max(same, default=-1)
            if most >= residue.SIMILAR * n:
                best = plain[max(i for i, x in enumerate(same) if x == most)]
                best[:] = [t if t == w else residue.WILD for t, w in zip(best, words, strict=True)]
            else:
                plain.append(words[:])
            tree.add(" ".join(words))
        assert next(iter(tree.leaves.values())) == plain


def test_rows_of_one_key_are_judged_each_by_itself(spark, rows):
    parts = spark.createDataFrame([("t", "u", "body", "Страница не найдена"), ("t", "u", "body", "Длинный абзац о сериале, который стоит прочитать целиком. " * 20)], "source_table string, record_key string, part string, text string")
    assert rows(residue.records(parts)) == {("t", "u")}


def test_residue_of_any_length_and_beside_its_likes(spark, rows):
    told = ["null " * 200, "Lorem ipsum dolor sit amet " * 90, "lorem ipsum dolor sit amet", "lorem ipsum dolor sit elit", "lorem ipsum dolor sit tempor", "Слово о герое без знаков и конца " * 40, "lorem ipsum dolor sit today"]
    parts = spark.createDataFrame([("t", str(i), "body", x) for i, x in enumerate(told)], "source_table string, record_key string, part string, text string").coalesce(1)
    assert rows(residue.records(parts)) == {("t", str(i)) for i in range(5)}


def test_residue_records(spark, rows):
    a = spark.createDataFrame([("f1", "404", "404", "", "", "x"), ("f2", "404", "Имя / Name", "Name", "Хорошее описание сериала.", "x"), ("f3", "Имя", "Имя / Name", "Name", "Please enable JavaScript to view this page", "x"), ("f4", "", "", None, None, "x")], "source_file string, html_title string, title_heading string, title string, description string, part string")
    n = spark.createDataFrame([(1, "404", "Имя", "", "Обычный текст новости.", None), (2, "Страница не найдена", "", "", "", None), (3, "x", "x y z", "", None, "lorem ipsum"), (3, "x", "x y z", "", None, "lorem ipsum")], "source_id bigint, page_title string, title string, foreword string, content_text string, content_html string")
    p = spark.createDataFrame([("u", bytearray(b"<body><main><h1>Loading</h1><p>Turn them on and reload</p></main></body>")), ("v", bytearray(b"")), ("w", bytearray(PAGE.format(charset="utf-8").encode()))], "url string, html binary")
    assert rows(residue.found(a, n, p)) == {("anime_pages", "f1"), ("anime_pages", "f3"), ("news", "2"), ("news", "3"), ("raw_pages", "u")}
    got = residue.body_blocks_found(p)
    assert {r["url"] for r in got.collect()} == {"w"} and got.count() == len(BODY)
    empty = residue.found(a.limit(0), n.limit(0), p.limit(0))
    assert empty.count() == 0
    s = spark.createDataFrame([(1, "a {{ x }} b {{ x }}", "k"), (2, None, "k")], "id int, t string, slot string")
    assert rows(residue.slots(s, ["id"], "t")) == {(1, "{{ x }}", 2)}


def test_pages_of_one_template_have_no_body_however_many(spark):
    """2,500 pages of one message, more than LEAF, are left out like four of them."""
    page = "<body><main><p>Could not render resource {} please try again</p></main></body>"
    of = [(str(i), bytearray(page.format("".join(chr(103 + int(c)) for c in str(i))).encode())) for i in range(2500)]
    p = spark.createDataFrame([*of, ("w", bytearray(PAGE.format(charset="utf-8").encode()))], "url string, html binary")
    for some in (p, p.where("url IN ('10', '11', '12', '13', 'w')")):
        assert {r["url"] for r in residue.body_blocks_found(some).select("url").distinct().collect()} == {"w"}


def test_a_template_decides_on_a_sentence_of_any_length(spark, rows):
    """47 words of which three change: by itself each is none, its template is a message, as of a short one."""
    long = "could not load resource {} please try again later or contact the administrator of this site and if the page is unavailable check your connection and wait until the server is back or return to the home page {} and try to load the resource {} again"
    said = [long.format(*w) for w in ("glimmer aspen plume".split(), "velvet quietus otter".split(), "harborlight moss fern".split(), "juniper wren yarrow".split())]
    assert len(said[0].split()) == 47 and not any(residue.judge(s) for s in said)
    parts = spark.createDataFrame([("t", str(i), "body", s) for i, s in enumerate(said)], "source_table string, record_key string, part string, text string")
    assert rows(residue.records(parts)) == {("t", str(i)) for i in range(4)}


@pytest.mark.parametrize("n", [20, 47, 90])
def test_templates_counted_in_a_large_leaf_are_those_of_all(n):
    """Sentences of few different words, where nearly every template shares a word: the same templates as comparing with each."""
    rng = random.Random(n)
    tree, plain, base = residue.Tree(), [], rng.choices("abcd", k=n - 3)
    for _ in range(400):
        kept = rng.choice((0.2, 0.6, 0.9))
        words = ["could", "not", "load"] + [w if rng.random() < kept else rng.choice("abcdefgh") for w in base]
        same = [sum(map(str.__eq__, t, words)) for t in plain]
        most = max(same, default=-1)
        if most >= residue.SIMILAR * n:
            best = plain[max(i for i, x in enumerate(same) if x == most)]
            best[:] = [t if t == w else residue.WILD for t, w in zip(best, words, strict=True)]
        else:
            plain.append(words[:])
        tree.add(" ".join(words))
    assert next(iter(tree.leaves.values())) == plain and 100 < len(plain) < 400


def test_pages_without_body_are_those_of_p7(spark, tmp_path, rows):
    """One page whose message is told only beside three news of the same template: p7_found lists it, so p5_found has no block of it."""
    said = [f"Could not render resource {w} please try again" for w in ("glimmer", "harborlight", "quietus", "velvet")]
    n = "source_id bigint, page_title string, title string, foreword string, content_text string, content_html string"
    spark.createDataFrame([(i, None, None, None, s, None) for i, s in enumerate(said[1:])], n).write.parquet(f"{tmp_path}/news.parquet")
    spark.createDataFrame([], "source_file string, html_title string, title_heading string, title string, description string").write.parquet(f"{tmp_path}/anime_pages.parquet")
    p = [("u", bytearray(f"<body><main><p>{said[0]}</p></main></body>".encode())), ("w", bytearray(PAGE.format(charset="utf-8").encode()))]
    spark.createDataFrame(p, "url string, html binary").write.parquet(f"{tmp_path}/raw_pages.parquet")
    assert {k for t, k in rows(catalogue.p7_found(spark, str(tmp_path))) if t == "raw_pages"} == {"u"}
    assert {u for u, _ in rows(catalogue.p5_found(spark, str(tmp_path)))} == {"w"}


def test_slots_of_all_tables(spark, tmp_path, rows):
    a = "source_file string, html_title string, title_heading string, title string, description string"
    spark.createDataFrame([("f1", "x", "Имя", "{{ name }}", "Хорошее описание, todo: дописать."), ("f2", "x", "Имя", "", "fixme later")], a).write.parquet(f"{tmp_path}/anime_pages.parquet")
    n = "source_id bigint, page_title string, title string, foreword string, content_text string, content_html string"
    spark.createDataFrame([(1, "x", "Новость %name%", "", "Текст ${x} и ${x}.", None)], n).write.parquet(f"{tmp_path}/news.parquet")
    spark.createDataFrame([("u", bytearray("<main><h1>Имя [[ slot ]]</h1><p>Обычный текст <%= y %> страницы.</p></main>".encode())), ("v", None)], "url string, html binary").write.parquet(f"{tmp_path}/raw_pages.parquet")
    got = {(t, k, p, s, n) for t, k, p, s, n in rows(catalogue.p7_slots(spark, str(tmp_path)))}
    assert got == {
        ("anime_pages", "f1", "head", "{{ name }}", 1), ("anime_pages", "f1", "description", "todo: дописать.", 1), ("anime_pages", "f2", "description", "fixme later", 1),
        ("news", "1", "head", "%name%", 1), ("news", "1", "body", "${x}", 2), ("raw_pages", "u", "head", "[[ slot ]]", 1), ("raw_pages", "u", "body", "<%= y %>", 1),
    }


# --- personal information

KNOWN = pii.Known(["Domori Boquashi", "Домори Бокваши", None])


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Почта: x_do-to+fan (at) inbox (dot) invalid.", [("email", "x_do-to+fan (at) inbox (dot) invalid")]),
        ("Пишите на ivan собака inbox точка invalid или A.B@POST.EXAMPLE.ORG.", [("email", "ivan собака inbox точка invalid"), ("email", "A.B@POST.EXAMPLE.ORG")]),
        ("ferry32 at studio-fan dot example dot net (x)", [("email", "ferry32 at studio-fan dot example dot net")]),
        ("Ник @lantern_fan, S01E05@1080p", []),
        ("Звоните +7 (900) 000-17-49 или 8 900 000 24 81, Call 00 1 305 555 0139.", [("phone", "+7 (900) 000-17-49"), ("phone", "8 900 000 24 81"), ("phone", "00 1 305 555 0139")]),
        ("Тел.: восемь девятьсот ноль ноль ноль три один три ноль", [("phone", "восемь девятьсот ноль ноль ноль три один три ноль")]),
        ("Паспорт 0000 № 328700, СНИЛС 000-829-196 93, Government ID 999 01 3381, my SSN QQ 67 09 03 C.", [("id_number", "0000 № 328700"), ("id_number", "000-829-196 93"), ("id_number", "999 01 3381"), ("id_number", "QQ 67 09 03 C")]),
        ("код товара 4412-88-1203, ISBN 978-5-17-000000-1, sold 8000000000 yen, билет 1500-00, 12.04.2019", []),
        ("Живу здесь: г. Светлояр-12, ул. Маячная, д. 144, кв. 255, заходите", [("address", "г. Светлояр-12, ул. Маячная, д. 144, кв. 255")]),
        ("Встреча — 000730, Каменный Брод, Паромная улица, 76-13.", [("address", "000730, Каменный Брод, Паромная улица, 76-13")]),
        ("I live at Flat 70, 56 Mossgate Close, Graymere 00482, come", [("address", "Flat 70, 56 Mossgate Close, Graymere 00482")]),
        ("С уважением, Клюпинов Б. З. Режиссёр", [("person_name", "Клюпинов Б. З.")]),
        ("Regards, Twistlewood, Clement\nSigned: Maud E. Larkin-Shaw.", [("person_name", "Twistlewood, Clement"), ("person_name", "Maud E. Larkin-Shaw")]),
        ("Меня зовут ЖИЛКАРОВ Борислав, я", [("person_name", "ЖИЛКАРОВ Борислав")]),
        ("My name is Domori Boquashi. Regards, Boquashi, Domori\nМеня зовут Домори Бокваши, С уважением, Д. Бокваши", []),
        ("unsigned MANUSCRIPT BEHIND the forge", []),
        ("", []),
    ],
)
def test_pii(text, want):
    assert [(k, text[a:b]) for k, a, b, _ in pii.find(text, KNOWN)] == want


@pytest.mark.parametrize("kind", ["пр.", "ш.", "туп.", "линия", "ул.", "набережная"])
def test_address_of_any_street_word(kind):
    assert [(k, x) for k, x in (("address", f"{kind} Ленина, д. 5"),)] == [(k, f"Живу: {kind} Ленина, д. 5."[a:b]) for k, a, b, _ in pii.find(f"Живу: {kind} Ленина, д. 5.", KNOWN)]


@pytest.mark.parametrize("text", ["<p>- один</p>", "текст<br># Глава", "– один\n– два", "<div>• один</div>"])
def test_markup_without_other_marks(text):
    assert elements(text) and set(elements(text)) <= set(elements(text + "\n\n$$x$$"))


def test_validators():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112") and pii.mod97("GB82 WEST 1234 5698 7654 32") and pii.snils("11223344595") and pii.inn("7707083893") and not pii.inn("7707083894")
    assert [k for k, *_ in pii.find("IBAN GB82 WEST 1234 5698 7654 32, карта 4111 1111 1111 1111, паспорт", KNOWN)] == ["id_number", "id_number"]


def test_redaction_changes_nothing_else(spark):
    text = "Пишите на a@b.example. " * 3000 + "Конец İ."
    out = pii.redact(text, KNOWN)
    assert out == "Пишите на [EMAIL]. " * 3000 + "Конец İ."
    df = spark.createDataFrame([(1, "a@b.example", "k"), (1, "a@b.example", "k"), (2, None, "k"), (3, "", "k")], "doc_id bigint, text string, pii_kind string")
    names = spark.createDataFrame([(None,), ("A B",)], "full_name string")
    assert {tuple(r) for r in pii.found(df, names).collect()} == {(1, "email", "a@b.example")}
    assert [r["text"] for r in pii.redacted(df, "doc_id", "text").orderBy("doc_id").collect()] == ["[EMAIL]", "[EMAIL]", None, ""]
    assert pii.found(df.limit(0), names.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("card 4111 1111 1111 1111, ok", [("id_number", "4111 1111 1111 1111")]),
        ("see 11223344595 there", [("id_number", "11223344595")]), ("ISBN 9780306406157", []), ("0000000000000000", []), ("4111 1111 1111 1112", []),
        ("I saw John Smith at the shop.", [("person_name", "John Smith")]), ("Yesterday Mary O'Connor came.", [("person_name", "Mary O'Connor")]), ("The doctor, Peter Brown, was late.", [("person_name", "Peter Brown")]),
        ("Вчера Иван Петров приходил к Марии Сидоровой.", [("person_name", "Иван Петров"), ("person_name", "Марии Сидоровой")]),
        ("The novel “John Smith” and John Smith Street, Mark Twice Award. Фильм «Иван Петров»", []),
        ("Anna Domori Boquashi. Большой Иванов дом. Mary met Peter.", []),
    ],
)
def test_pii_without_a_word_beside_it(text, want):
    assert [(k, text[a:b]) for k, a, b, _ in pii.find(text, KNOWN)] == want


def test_more_public_names_than_are_broadcast(spark, rows):
    texts = ["My name is Domori Boquashi.", "Regards, Twistlewood, Clement", "С уважением, Д. Бокваши", None, "Вчера Иван Петров и John Smith писали на a@b.example"]
    df = spark.createDataFrame([(i % 4, t, "x") for i, t in enumerate(texts * 2)], "doc_id int, text string, form string")
    names = spark.createDataFrame([("Domori Boquashi",), ("Домори Бокваши",), ("Иван Петров",), (None,), ("x",)], "full_name string")
    near, far = (sorted(pii.pii_spans(df, "doc_id", "text", names, limit=n).collect()) for n in (100, 1))
    assert near == far and {r["pii_text"] for r in far} == {"Twistlewood, Clement", "John Smith", "a@b.example"}
    assert sorted(map(repr, pii.redacted(df, "doc_id", "text", names, limit=1).collect())) == sorted(map(repr, pii.redacted(df, "doc_id", "text", names).collect()))


AROUND = "<div><p>Реклама</p><p>Смотри тут</p><p>Подробнее</p></div><p>Длинный абзац о сериале, который стоит прочитать целиком.</p>"


def test_edges_decide_on_lines_of_no_clear_kind():
    told = lambda t, smooth: [b.text for b in markup.content(markup.blocks(t), smooth=smooth)]
    end = "Длинный абзац о сериале, который стоит прочитать целиком."
    assert told(AROUND, True) == [end] and told(AROUND, False) == ["Смотри тут", end]
    assert told(f"<p>{end}</p><p>Смотри тут</p><p>{end}</p>", True) == [end, "Смотри тут", end]
    apart = AROUND.replace("<p>Смотри тут</p>", "<section><div><p>Смотри тут</p></div></section>")  # further off in the tree
    assert told(apart, True) == ["Смотри тут", end]


def test_distance_in_the_tree():
    a, b, c = markup.blocks("<div><p>a</p><section><p>b</p></section></div><p>c</p>")
    assert (markup.distance(a, a), markup.distance(a, b), markup.distance(b, c), markup.distance(a, c)) == (0, 1, 2, 1)


def test_costs_are_fitted_on_labelled_blocks(spark):
    assert markup.fit({}) == markup.PRIOR and markup.fit(markup.counted(markup.labelled("<p>только текст.</p>"))) == markup.PRIOR
    texts = [f"<span class='marker'>spoiler</span><p>Перейти к магазину</p><p>Текст номер {i}, в котором {i * 7} слов и больше.</p><h2>Глава {i}</h2>" for i in range(400)]
    before, after = markup.PRIOR, markup.fit(markup.counted([x for t in texts for x in markup.labelled(t)]))
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert markup.learned(df.repartition(1), "t") == markup.learned(df.repartition(7), "t") == after and markup.learned(df.limit(0), "t") == before
    line, head = markup.blocks("<p>Перейти к магазину</p><h2>Глава</h2>")
    assert markup.costs(line, before)[0] < markup.costs(line, before)[1] and markup.costs(line, after)[0] > markup.costs(line, after)[1]
    assert markup.costs(head, after)[0] < 0.1 * markup.costs(head, after)[1]


@pytest.mark.parametrize("name", ["reviews", "news", "animes"])
def test_elements_are_the_content_blocks_of_every_text(spark, name):
    key, column = {n: (k, c) for n, k, c in markup.SOURCES}[name]
    texts = [r[0] for r in spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").select(column).collect()]
    assert any(texts)
    for t in texts:
        assert elements(t) == [(b.kind, b.text) for b in markup.content(markup.blocks(t)) if b.kind in markup.STRUCTURE]
        assert all(elements(x) == elements(x + "\n\n$$x$$")[:-1] for x in [t or ""] if "$" not in x and "`" not in x and "~" not in x)


def test_rendered_texts_hold_the_blocks_row_by_row(spark):
    """The rendered text of every page, read back line by line, gives the blocks of the page in order."""
    n = 0
    for (raw,) in spark.read.parquet("/root/testdata/sf0.01/raw_pages.parquet").select("html").collect():
        root, blocks, _ = pages.parse(pages.decode(raw))
        own = pages.body(root, blocks)[1]
        at = [b for _, lines in pages.layout(own) for line in lines for b in line]
        assert at == own
        lines = iter(x for x in pages.rendered(own).split("\n") if x)
        for kind, rows_ in pages.layout(own):
            for row in rows_:
                line = next(lines)
                n += 1
                if kind == "table":
                    for b in row:
                        assert line.startswith(b.text)
                        line = line[len(b.text) :].lstrip()
                    assert not line
                else:
                    assert line == {"list": "- ", "head": "#" * int(row[0].node.tag[1:] or 0) + " " if kind == "head" else "", "text": ""}[kind] + row[0].text
        assert next(lines, None) is None
    assert n > 1000


@pytest.mark.parametrize("label", ["Related stories", "More articles", "You may also like", "Похожие новости", "Смотрите также", "Рекомендуем прочитать:"])
def test_labels_over_other_pages_are_no_body(label):
    root, blocks, _ = pages.parse(f"<body><main><h1>Имя</h1><p>{LONG} один.</p><div>{label}</div><p>{LONG} два.</p></main></body>")
    assert [b.text for b in pages.body(root, blocks)[1]] == ["Имя", f"{LONG} один.", f"{LONG} два."]
