"""Extraction jobs X0-X8 on mails built card by card: several cards, noise between them, CRLF, missing cells."""

from dataclasses import dataclass, field

import pytest

from pyspark.sql import functions as F

from alertlake.operators import extract as X
from alertlake.operators import links as L

NOISE = '<p style="margin:0">Pr&eacute;f&eacute;rences | <a href="https://example.org/desabo?x=1">Se d&eacute;sabonner</a></p>'


@dataclass
class Mail:
    """A mail body made of cards; ``eol`` is its line end."""

    cards: list[str] = field(default_factory=list)
    subject: str = ""
    eol: str = "\n"

    @property
    def html(self):
        lines = ["<html><body>", NOISE]
        for c in self.cards:
            lines += [c, NOISE]
        return self.eol.join("\n".join([*lines, "</body></html>"]).split("\n"))


def run(spark, job, mail):
    df = spark.createDataFrame([("<m1>", "p", mail.subject, mail.html)],
                               "message_id string, provider_key string, subject string, html string")
    return [r.asDict() for r in job(df).orderBy("offer_pos").collect()]


def pick(rows, *names):
    return [tuple(r[n] for n in names) for r in rows]


def ft_card(number, title, place=None, company=None, after=""):
    cells = "".join(f"<span>{c}</span>" for c in (company, place) if c)
    return (f'<a href="https://candidat.francetravail.fr/offres/recherche/detail/{number}?mtm=alerte" style="c">\n<span class="t">'
            f"{title}<br/>{cells}</span></a>\n<em>{after}</em>")


def ia_card(title, link, cells=(), after=""):
    style = "font-family:x;color:#2d2d2d;font-size:14px;line-height:21px;padding:0"
    rows = "".join(f'<tr><td style="{style}">{c}</td></tr>\n' for c in cells)
    return f'<h2 class="h"><a href="{link}" target="_blank">{title}</a></h2>\n<table>{rows}</table>{after}'


def li_card(number, title, info=None, after=""):
    line = f'<p class="t line-clamp-1 x">\n{info}</p>' if info else ""
    return f'<a href="https://www.linkedin.com/comm/jobs/view/{number}/?tracking=1" class="b">{title}</a>{line}<p>{after}</p>'


def jj_card(n, title, platform, city=None, company=None, pay="", after=""):
    spans = "".join(f"<span{a}>{v}</span>" for a, v in (("", city), (' style="color:#000000;x:y"', company)) if v)
    return (f'<a class="c" href="https://emails.jobijoba.com/clic/a-b-c/{n}/tok/k{n}"><span><strong title="{title} - {platform}">{title}'
            f"</strong>{spans}</span>{pay}<i>{after}</i></a>")


def pay(low, high, period):
    euro = "<span itemprop='salaryCurrency'>€</span>"
    return f"{low} {euro} à {high} {euro} {period}"


def tc_card(title, token=None, place=None, company=""):
    link = f"https://fr.talent.com/redirect?id={token}&amp;p=2" if token else "https://fr.talent.com/view"
    cells = (f'<tr><td style="x;color: #691f74">{place}</td></tr><tr><td style="color:#30183f;y">{company}</td></tr>') if place else ""
    return f'<a class="l" href="{link}">{title}</a><table>{cells}</table>'


@pytest.mark.parametrize("eol", ["\n", "\r\n"])
def test_france_travail_cards(spark, eol):
    mail = Mail([ft_card("101AAAA", "Soudeur &amp; tuyauteur", "59 - Lille", "Atelier Nord", "CDI 35h"),
                 ft_card("102BBBB", "Aide-soignante", "2 rue X"),
                 ft_card("101AAAA", "Soudeur bis", "62 - Arras"),
                 ft_card("103CCCC", "Magasinier", "35 -  Rennes")], eol=eol)
    got = run(spark, X.extract_france_travail, mail)
    assert pick(got, "titre", "entreprise", "ville", "dept", "notes") == [
        ("Soudeur & tuyauteur", "Atelier Nord", "Lille", "59", "Offre n°101AAAA"),
        ("Aide-soignante", "", "", "", "Offre n°102BBBB"),
        ("Magasinier", "", "Rennes", "35", "Offre n°103CCCC")]
    assert got[0]["type_contrat"] == "CDI"
    assert {r["url_qualite"] for r in got} == {"construite"}
    assert got[2]["url"].endswith("/detail/103CCCC")


@pytest.mark.parametrize("eol", ["\n", "\r\n"])
def test_indeed_alert_cards(spark, eol):
    jk = "https://fr.indeed.com/rc/clk/dl?jk={}&amp;tk=z".format
    mail = Mail([ia_card("Boulangère", jk("00000000000000aa"), ["Four Doré", "Brest (29)"], "Stage"),
                 ia_card("Vendeur", "https://fr.indeed.com/pagead/clk?a=1&amp;b=2", ["Maison Lin"]),
                 ia_card("Boulangère bis", jk("00000000000000aa")),
                 ia_card("&nbsp;-&nbsp;", jk("00000000000000ab")),
                 ia_card("Livreur", jk("00000000000000ac"), ["Vélo", "Partout en ville"]),
                 ia_card("Vendeur", "https://fr.indeed.com/pagead/clk?a=1&amp;b=2")], eol=eol)
    got = run(spark, X.extract_indeed_alerte, mail)
    by_title = {r["titre"]: r for r in got}
    assert [r["titre"] for r in got if r["titre"] not in ("-", "")][:1] == ["Boulangère"]
    assert pick([by_title["Boulangère"]], "entreprise", "ville", "dept", "type_contrat", "url", "url_qualite") == [
        ("Four Doré", "Brest", "29", "Stage", "https://fr.indeed.com/viewjob?jk=00000000000000aa", "construite")]
    assert pick([by_title["Vendeur"]], "entreprise", "ville", "url", "url_qualite") == [
        ("Maison Lin", "", "https://fr.indeed.com/pagead/clk?a=1&b=2", "email")]
    assert (by_title["Livreur"]["ville"], by_title["Livreur"]["dept"]) == ("Partout en ville", "")
    assert "Boulangère bis" not in by_title and sum(r["titre"] == "Vendeur" for r in got) == 1


@pytest.mark.parametrize("body,subject,want", [
    ("Salut, Fer &amp; Fils recrute. Fer &amp; Fils 38000 Saint-Martin Salaire au choix CDD", "Forgeron – H/F – Fer & Fils",
     ("Forgeron – H/F", "Fer & Fils", "Saint-Martin", "38", "CDD")),
    ("Zinc (SARL) La Ciotat (13)", "Couvreur – Zinc (SARL)", ("Couvreur", "Zinc (SARL)", "La Ciotat", "13", "")),
    ("Octo Télétravail", "Testeur – Octo", ("Testeur", "Octo", "Télétravail", "", "")),
    (r"A\E.B Paris (75)", r"Monteur – A\E.B", ("Monteur", r"A\E.B", "Paris", "75", "")),
    ("Nantes (44) Freelance", "Monteur – ", ("Monteur", "", "", "", "Freelance")),
])
def test_indeed_match_places(spark, body, subject, want):
    got = run(spark, X.extract_indeed_match, Mail([f'<p>{body}</p><a href="https://cts.indeed.com/v3/t0k">v</a>'], subject))
    assert pick(got, "titre", "entreprise", "ville", "dept", "type_contrat") == [want]
    assert pick(got, "url", "url_qualite") == [("https://cts.indeed.com/v3/t0k", "email")]


def test_indeed_match_needs_a_title(spark):
    assert run(spark, X.extract_indeed_match, Mail(["<p>x</p>"], "Sans tiret long")) == []


def test_linkedin_cards(spark):
    mail = Mail([li_card(7001, "Architecte bois", "Chêne SA · Annecy (Sur site)", "Freelance"),
                 li_card(7002, "Dessin"),
                 li_card(7001, "Architecte bois, encore"),
                 li_card(7003, "&amp;&amp;"),
                 li_card(7004, "Ébéniste d&#39;art", "Atelier · Pau")])
    got = run(spark, X.extract_linkedin, mail)
    assert [r["url"].rsplit("/", 1)[1] for r in got] == ["7001", "7002", "7004"]
    assert pick(got[:1], "titre", "entreprise", "ville", "type_contrat") == [("Architecte bois", "Chêne SA", "Annecy", "Freelance")]
    assert pick(got[2:], "entreprise", "ville") == [("Atelier", "Pau")]


def test_meteojob_links_in_their_order(spark):
    subject = "  Groupe Sel RECRUTE UN  saunier  "
    plain = '<a href="https://www.meteojob.com/jobs/11?a=1">x</a>'
    page = '<a href="https://www.meteojob.com/candidat/offres/offre-d-emploi-saunier-12">x</a>'
    button = '<a class="hotoffer-cta-link" style="x" href="https://www.meteojob.com/jobs/13?b=2&amp;c=3">x</a>'
    for cards, url in (([plain], "jobs/11?a=1"), ([plain, page], "offre-d-emploi-saunier-12"), ([plain, page, button], "jobs/13?b=2&c=3")):
        got = run(spark, X.extract_meteojob_company, Mail([*cards, "<p>Guérande (44), CDD</p>"], subject))
        assert pick(got, "entreprise", "titre", "ville", "dept", "type_contrat") == [("Groupe Sel", "saunier", "Guérande", "44", "CDD")]
        assert got[0]["url"].endswith(url)
    assert run(spark, X.extract_meteojob_company, Mail(["<p>x</p>"], "Vos offres")) == []


def test_jobijoba_cards(spark):
    mail = Mail([jj_card(1, "Jardinier", "serre.fr", "Angers", "Les Serres", pay("1 900", "2 100", "par mois"), "CDD"),
                 jj_card(2, "Fleuriste - nuit", "jobijoba.com", "Tours", pay=pay("24 000", "26 000", "par an")),
                 jj_card(3, "ab", "x.fr"),
                 jj_card(4, "Pépiniériste", "x.fr")])
    got = run(spark, X.extract_jobijoba, mail)
    assert pick(got, "titre", "ville", "salaire_min", "salaire_max", "notes") == [
        ("Jardinier", "Angers", "22800", "25200", "Via Jobijoba (serre.fr)"),
        ("Fleuriste - nuit", "Tours", "24000", "26000", ""),
        ("Pépiniériste", "", "", "", "Via Jobijoba (x.fr)")]
    assert [r["url"][-2:] for r in got] == ["k1", "k2", "k4"]
    assert (got[0]["entreprise"], got[0]["type_contrat"]) == ("Les Serres", "CDD")


def test_jobijoba_titles_do_not_overlap(spark):
    """A title runs to the last separator of its line, over whatever looks like another title."""
    inner = '<img title="Logo"><strong title="Maçon - y.fr">Maçon</strong>'
    got = run(spark, X.extract_jobijoba, Mail([inner, jj_card(2, "Carreleur", "z.fr")]))
    assert [r["titre"] for r in got] == ['Logo"><strong title="Maçon', "Carreleur"]


def test_talent_anchors(spark):
    cards = [tc_card("Grutier - CDI", "0a1", "Dunkerque, Nord, France", "Levage"), tc_card("Afficher toutes les offres", "0a2"),
             tc_card("Contactez-nous", "0a3"), tc_card("Pontier", None, "Calais")]
    got = run(spark, X.extract_talent_com, Mail(cards))
    assert pick(got, "titre", "ville", "entreprise", "type_contrat", "url_qualite") == [
        ("Grutier - CDI", "Dunkerque", "Levage", "CDI", "email"), ("Pontier", "Calais", "", "", "vide")]
    assert got[0]["url"] == "https://fr.talent.com/redirect?id=0a1&p=2"
    many = Mail([tc_card(f"Poste de quai {i}", f"ff{i:02d}") for i in range(31)])
    assert len(run(spark, X.extract_talent_com, many)) == 20


def test_jobs_take_their_own_mails_only(spark):
    mails = [("<a>", "linkedin", "", Mail([li_card(1, "Métallier")]).html), ("<b>", "talent_com", "", Mail([tc_card("Tourneur", "aa")]).html),
             ("<c>", "linkedin", "", Mail([tc_card("Fraiseur", "ab")]).html), ("<d>", "hellowork", "", Mail([li_card(2, "Ajusteur")]).html),
             ("<e>", "jobijoba_alerte", None, None)]
    out = X.extract_offers(spark.createDataFrame(mails, "message_id string, provider_key string, subject string, html string"))
    assert sorted((r["message_id"], r["titre"]) for r in out.collect()) == [("<a>", "Métallier"), ("<b>", "Tourneur")]
    assert out.columns == ["message_id", "offer_pos", "provider_key", *X.fixed.RAW_OFFER_FIELDS]


def test_many_links_cost_no_more_than_their_number(spark):
    """In-mail de-duplication evaluates the match array once, so twice the links are not four times the work."""
    import time

    def seconds(n):
        mail = Mail([li_card(i % (n // 2), f"Emploi {i}") for i in range(n)])
        began = time.perf_counter()
        assert len(run(spark, X.extract_linkedin, mail)) == n // 2
        return time.perf_counter() - began

    seconds(50)
    assert seconds(800) < 6 * max(seconds(200), 0.5)


def test_linkedin_places_in_long_mails_equal_a_search(spark):
    import random
    import re

    rng = random.Random(4)
    for size in (20, 41, 6000):
        for _ in range(8):
            ids = [str(rng.choice([1, 12, 123, 77, 770, 9])) for _ in range(rng.randint(1, 40))]
            text = "".join(rng.choice(["é😀x", "jobs/", "\n", "view/"]) * rng.randint(0, 9) + f"jobs/view/{i}" for i in ids) + "z" * rng.randint(0, 9)
            asked = list(dict.fromkeys(ids)) + ["5"]
            df = spark.createDataFrame([(text, asked)], "t string, ids array<string>").withColumn("b", L.blocks(F.col("t"), size))
            row = df.select(L.places(F.col("b"), size, "jobs/view/").alias("p"),
                            L.least_places(L.places(F.col("b"), size, "jobs/view/"), F.col("ids")).alias("at")).first()
            assert [p.at for p in row.p] == [x.start() for x in re.finditer("jobs/view/", text)]
            assert row.at == [None if (at := text.find("jobs/view/" + i)) < 0 else at for i in asked]


def test_linkedin_window_of_each_job(spark):
    filler = "é" * 2950
    cards = [li_card(10 ** k, f"Poste {k} ici", f"Firme {k} · Ville {k}", filler + (" CDI " if k % 2 else "")) for k in range(12)]
    got = pick(run(spark, X.extract_linkedin, Mail(cards)), "titre", "entreprise", "ville")
    # an id that begins with a shorter one is found where the shorter one is first: at its own link, which comes first
    assert got == [(f"Poste {k} ici", f"Firme {k}", f"Ville {k}") for k in range(12)]
    back = pick(run(spark, X.extract_linkedin, Mail(cards[::-1])), "titre", "entreprise")
    assert back == [(f"Poste {k} ici", "Firme 11") for k in range(11, -1, -1)]  # "1" is first found in the last id's link
