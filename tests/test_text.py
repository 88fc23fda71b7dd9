import random
from urllib.parse import unquote

import pytest

from nomina.functions import markup, text
from nomina.operators.transformers import EntityExtractor, normalization_pipeline

LEGAL = 'ООО "Рога и Копыта"'


def test_organisation_suffixes(column):
    names = ["Some Big Pharma, LLC", "Some Big Pharma, LTD", "Acme GmbH & Co. KG", "Acme Ltd.", "Pirelli Neumaticos S.A.I.C.", "Co", "Incline"]
    assert column(text.remove_organisation_suffixes, names) == [
        "Some Big Pharma", "Some Big Pharma", "Acme", "Acme", "Pirelli Neumaticos", "Co", "Incline",
    ]


def test_lowercase(column):
    assert column(text.lowercase, [LEGAL]) == ['ооо "рога и копыта"']


def test_numbers(column):
    names = ['ООО "Рога и Копыта 123"', "a 1 b", "a1b", "x 12 34 y", "٣ три"]
    assert column(text.remove_numbers, names) == [LEGAL, "ab", "a b", "xy", "три"]


def test_non_words(column):
    names = ['ООО "Рога и Копыта 123"', 'ООО "Рога и Копыта ()"', "a_b", "ёж и Ко"]
    assert column(text.remove_non_words, names) == ["ООО Рога и Копыта 123", "ООО Рога и Копыта", "a_b", "ёж и Ко"]


def test_legal_forms(column):
    names = ["ооо рога и копыта групп", "лооотд", "какао группа", "OOO ООО", "ПАО ТЕСТ"]
    # "лтд" only comes into being by a removal, so it stays; "П" is what "АО" leaves of "ПАО" unless that goes first.
    assert column(text.remove_legal_forms, names) == ["рога и копыта", "лтд", "как а", "ООО", "ТЕСТ"]


def test_stop_words_mix_scripts():
    latin = [w for w in text.LEGAL_FORM_WORDS if w.isascii()]
    assert latin == ["OOO", "OAO", "AO"]
    assert len(text.LEGAL_FORM_WORDS) == 23 and len(set(text.LEGAL_FORM_WORDS)) == 18


def test_transliteration(column):
    names = ['ООО "Рога и Копыта 123"', "Щука Ёж", "Straße Čapek Ångström", "日本"]
    assert column(text.transliterate, names) == ['OOO "Roga i Kopyta 123"', "Shchuka Iozh", "Strasse Capek Angstrom", "日本"]


PIPELINE = {
    '"Big Pharma", LTD': "big pharma",
    '"Big Pharma 123", LLC': "big pharma",
    'ооо 123 "рога и копыта групп" 456': "roga i kopyta",
    "ооо рога и копыта групп": "roga i kopyta",
}


def test_pipeline(column, spark):
    assert column(text.normalize, list(PIPELINE)) == list(PIPELINE.values())
    names = spark.createDataFrame([(n,) for n in PIPELINE], "name string")
    fitted = normalization_pipeline().fit(names)
    assert [r.name for r in fitted.transform(names).collect()] == list(PIPELINE.values())
    assert fitted.transform(names.limit(0)).collect() == []


def test_pipeline_takes_an_entity_extractor(spark):
    from pyspark.sql import functions as F

    step = EntityExtractor(inputCol="name", outputCol="name").using(lambda c: F.regexp_extract(c, "^(\\w+)", 1))
    assert step.transform(spark.createDataFrame([("VK mobile version | VK",)], "name string")).first().name == "VK"


def first_word(c):
    from pyspark.sql import functions as F

    return F.regexp_extract(c, "^(\\w+)", 1)


def test_a_saved_entity_extractor_keeps_its_function(spark, tmp_path):
    names = spark.createDataFrame([("VK mobile version | VK",)], "name string")
    EntityExtractor().using(first_word).write().save(str(tmp_path / "step"))
    assert EntityExtractor.load(str(tmp_path / "step")).transform(names).first().name == "VK"
    EntityExtractor().write().save(str(tmp_path / "plain"))
    assert EntityExtractor.load(str(tmp_path / "plain")).transform(names).first().name == "VK mobile version | VK"
    with pytest.raises(ValueError):
        EntityExtractor().using(lambda c: c).write()


def test_capitalize(column):
    assert column(text.capitalize, ["big PHARMA co", "ёж И", ""]) == ["Big pharma co", "Ёж и", ""]


def test_strip_and_words_follow_unicode(column):
    samples = ["\t  a b 　\n", "\x1cx\x1f", "a b  c", ""]
    assert column(text.strip, samples) == [s.strip() for s in samples]
    assert column(text.words, samples) == [s.split() for s in samples]


def test_index_terms(column):
    assert column(text.index_terms, ["https://www.Yandex.ru/о-нас?x=1", "L'Oréal & Co."]) == [
        ["https", "www.yandex.ru", "о", "нас", "x", "1"],
        ["l'oréal", "co"],
    ]


def test_percent_decode(column):
    samples = ["a%2", "a+b%20c", "%D0%96", "100%25 a%2", "plain", "%zz%41"]
    assert column(text.percent_decode, samples) == [unquote(s) for s in samples]


@pytest.mark.parametrize("seed", range(3))
def test_words_match_python_on_random_text(column, seed):
    rng = random.Random(seed)
    samples = ["".join(rng.choices("abЖ \t  ,_1", k=12)) for _ in range(50)]
    assert column(text.words, samples) == [s.split() for s in samples]


def test_title(column):
    pages = [
        '<html><TITLE lang="x">A &amp; B &#1046;&#x416; &nope; & &eacute;</title><title>second</title>',
        "<title>\n two lines </title>",
        "no title",
    ]
    assert column(markup.title, pages) == ["A & B ЖЖ &nope; & é", "\n two lines ", ""]


def test_result_links(column):
    hit = '<div class="g"><a href="{}"><h3>T</h3></a><div style="-webkit-line-clamp:2"><span>d</span></div></div>'
    page = hit.format("https://a.example/1") + hit.format("https://vk.com/x")
    page += '<div class="g"><a href="https://no-heading.example/"></a></div>' + hit.format("https://b.example/?x=1&amp;y=2")
    assert column(markup.result_links, [page, "<p>none</p>"]) == [
        ["https://a.example/1", "https://vk.com/x", "https://b.example/?x=1&y=2"],
        [],
    ]


def test_hits_end_where_their_element_ends(column):
    box = '<div style="-webkit-line-clamp:2">{}</div>'
    whole = "<a href=/in?a=1&amp;b=2><h3>T</h3></a>" + box.format("<p><span>d")
    pages = [
        f'<div class="g">{whole}</div>',
        f'<div class="g"><div>{whole}</div><br><img src=x></div>',
        '<div class="g"><h3>T</h3>' + box.format("<span>d</span>") + '</div><a href="/out">',  # link outside
        '<div class="g"><a href="/x"></a>' + box.format("<span>d</span>") + "</div><h3>T</h3>",  # heading outside
        '<div class="g"><a href="/x"><h3>T</h3></a>' + box.format("") + "<span>d</span></div>",  # span after its element
        f'<div class="g"><script>"</div>"</script><!-- </div> --></p>{whole}</div>',
        f'<div class="a g b"><a href="/outer"></a><div class="g">{whole}</div></div>',  # one inside another
        f"<div class='g'><a name=x></a><b title='>'>{whole}",  # never ends
        "<div class=g><a href='/q'><H3>T</H3></a><DIV style='-webkit-line-clamp:2'><span></DIV></div>",
        '<div class="gg"><a href="/x"><h3>T</h3></a>' + box.format("<span>"),
        "", "<div class='g", None,
    ]
    link = "/in?a=1&b=2"
    assert column(markup.result_links, pages) == [[link], [link], [], [], [], [link], ["/outer", link], [link], ["/q"], [], [], [], []]


def test_links_without_quotes_and_all_named_references(column):
    pages = ["<a href=/a?x=1&amp;y=2>1</a><a class='c' href = '/b'><a data-href=/no href=\"/c d\">", "<a href=>"]
    assert column(markup.links, pages) == [["/a?x=1&y=2", "/b", "/c d"], []]
    names = ["&NotEqualTilde;&ngE;&colon;&Tab;&amp;&fjlig;&unknown;"]
    assert column(markup.unescape, names) == ["\u2242\u0338\u2267\u0338:\t&fj&unknown;"]


def test_excluded_links(column):
    urls = ["https://vk.com/x", "https://vk.com/", "http://vk.com/x", "https://www.ok.ru/a", "see https://vk.com/x", "https://www.wikipediaXorg/a"]
    assert column(markup.is_excluded, urls) == [True, False, False, True, False, True]
