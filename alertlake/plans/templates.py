"""Registered queries of the extraction jobs X1-X7.

``part`` stands for the offers: five rows make a mail of five cards (or one row a mail, for the
templates that hold one offer), written in the provider's template with noise between the cards.
The SQL states what a reader of such a mail expects, straight from the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertlake import fixed
from alertlake.operators import extract as X
from alertlake.plans import views as V
from alertlake.plans.registry import register

#: Longer than any window in which a template looks for a contract word.
NOISE = "<p>" + "- " * 500 + "</p>\n"
CARDS = 5

SQL_CARDS = f"""cards AS (
  SELECT p_partkey AS k, p_partkey % {CARDS} AS i, '<m' || (p_partkey // {CARDS})::VARCHAR || '@part>' AS mail,
         '<p' || p_partkey::VARCHAR || '@part>' AS own, p_name || ' & fils' AS title, p_brand AS company,
         substr(p_type, 1, 1) || lower(substr(p_type, 2)) AS city, lpad((p_size % 95 + 1)::VARCHAR, 2, '0') AS dept,
         CASE p_size % 3 WHEN 0 THEN 'CDI' WHEN 1 THEN 'CDD' ELSE '' END AS contract, p_size AS size FROM part)"""


def _cards(spark, d) -> DataFrame:
    p = V.table(spark, d, "part")
    k = F.col("p_partkey")
    return p.select(
        k.alias("k"), (k % CARDS).alias("i"),
        F.concat(F.lit("<m"), F.floor(k / CARDS).cast("string"), F.lit("@part>")).alias("mail"),
        F.concat(F.lit("<p"), k.cast("string"), F.lit("@part>")).alias("own"),
        F.concat("p_name", F.lit(" &amp; fils")).alias("title"), F.col("p_brand").alias("company"),
        F.concat(F.substring("p_type", 1, 1), F.lower(F.expr("substr(p_type, 2)"))).alias("city"),
        F.lpad((F.col("p_size") % 95 + 1).cast("string"), 2, "0").alias("dept"),
        F.when(F.col("p_size") % 3 == 0, F.lit("CDI")).when(F.col("p_size") % 3 == 1, F.lit("CDD")).otherwise(F.lit("")).alias("contract"),
        F.col("p_size").alias("size"))


def _text(template: str, **values: Column) -> Column:
    """A card: ``{name}`` stands for a column."""
    parts = []
    for piece in template.replace("{", "\0{").replace("}", "}\0").split("\0"):
        name = piece[1:-1] if piece.startswith("{") and piece.endswith("}") else None
        parts.append(values.get(name, F.col(name)) if name else F.lit(piece))
    return F.concat(*parts)


def _mails(cards: DataFrame, card: Column, provider: str) -> DataFrame:
    """One mail of the cards in order, noise after each."""
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", card.alias("card")))), lambda c: c["card"]), NOISE)
    return cards.groupBy(F.col("mail").alias("message_id")).agg(F.concat(F.lit(NOISE), joined, F.lit(NOISE)).alias("html")) \
        .select("message_id", F.lit(provider).alias("provider_key"), F.lit("").alias("subject"), "html")


def _singles(cards: DataFrame, subject: Column, html: Column, provider: str) -> DataFrame:
    return cards.select(F.col("own").alias("message_id"), F.lit(provider).alias("provider_key"), subject.alias("subject"), html.alias("html"))


def _sql(provider: str, where: str = "true", message: str = "mail", pos: str = "i + 1", **fields: str) -> str:
    chosen = {"titre": "title", "entreprise": "company", "ville": "city", "dept": "dept", "type_contrat": "contract", **fields}
    columns = ", ".join(f"{chosen.get(f, repr(''))} AS {f}" for f in fixed.RAW_OFFER_FIELDS)
    return V.with_ctes(SQL_CARDS, body=f"SELECT {message} AS message_id, ({pos})::BIGINT AS offer_pos, '{provider}' AS provider_key, "
                                       f"{columns} FROM cards WHERE {where}")


def _number() -> Column:
    """A card's number; the last card of a mail repeats that of the first one, which wins."""
    return F.when(F.col("i") == CARDS - 1, F.col("k") - (CARDS - 1)).otherwise(F.col("k"))


@register("q_extract_france_travail", _sql(
    "france_travail", f"i <> {CARDS - 1}", url="'https://candidat.francetravail.fr/offres/recherche/detail/P' || lpad(k::VARCHAR, 7, '0')",
    url_qualite="'construite'", notes="'Offre n°P' || lpad(k::VARCHAR, 7, '0')"))
def q_extract_france_travail(spark, d):
    card = _text('<a href="https://candidat.francetravail.fr/offres/recherche/detail/P{n}?m=1" class="x">\r\n<span class="t">{title}<br/>'
                 "<span>{company}</span><span>{dept} - {city}</span></span></a><em>{contract}</em>",
                 n=F.lpad(_number().cast("string"), 7, "0"))
    return X.extract_france_travail(_mails(_cards(spark, d), card, "france_travail"))


@register("q_extract_indeed_alerte", _sql(
    "indeed_alerte", f"i <> {CARDS - 1}",
    url="CASE WHEN i = 3 THEN 'https://fr.indeed.com/pagead/clk?a=1&b=' || k::VARCHAR "
        "ELSE 'https://fr.indeed.com/viewjob?jk=' || lpad(k::VARCHAR, 16, '0') END",
    url_qualite="CASE WHEN i = 3 THEN 'email' ELSE 'construite' END"))
def q_extract_indeed_alerte(spark, d):
    link = F.when(F.col("i") == 3, F.concat(F.lit("https://fr.indeed.com/pagead/clk?a=1&amp;b="), F.col("k").cast("string"))).otherwise(
        F.concat(F.lit("https://fr.indeed.com/rc/clk?jk="), F.lpad(_number().cast("string"), 16, "0"), F.lit("&amp;t=2")))
    cell = '<td style="x;color:#2d2d2d;font-size:14px;line-height:21px;y">'
    card = _text('<h2 class="h"><a href="{link}" id="z">{title}</a></h2><table><tr>' + cell + "{company}</td></tr><tr>" + cell
                 + "{city} ({dept})</td></tr></table><p>{contract}</p>", link=link)
    return X.extract_indeed_alerte(_mails(_cards(spark, d), card, "indeed_alerte"))


@register("q_extract_indeed_match", _sql(
    "indeed_match", message="own", pos="1", titre="replace(title, '&', '&amp;')", url="'https://cts.indeed.com/v3/t' || k::VARCHAR",
    url_qualite="'email'"))
def q_extract_indeed_match(spark, d):
    html = _text('<p>Bonjour, {company} recrute.</p><a href="https://cts.indeed.com/v3/t{n}">Voir</a><p>{company} {dept}000 {city} '
                 "Salaire selon profil {contract}</p>", n=F.col("k").cast("string"))
    return X.extract_indeed_match(_singles(_cards(spark, d), _text("{title} – {company}"), html, "indeed_match"))


@register("q_extract_linkedin", _sql(
    "linkedin", f"i <> {CARDS - 1}", dept="''", url="'https://www.linkedin.com/jobs/view/' || lpad(k::VARCHAR, 9, '0')", url_qualite="'construite'"))
def q_extract_linkedin(spark, d):
    card = _text('<a href="https://www.linkedin.com/comm/jobs/view/{n}/?t=1" class="b">{title}</a><p class="a line-clamp-1 b"> '
                 "{company} · {city} (Hybride)</p><p>{contract}</p>", n=F.lpad(_number().cast("string"), 9, "0"))
    return X.extract_linkedin(_mails(_cards(spark, d), card, "linkedin"))


@register("q_extract_meteojob", _sql(
    "meteojob_company", message="own", pos="1", titre="replace(title, '&', '&amp;')",
    url="'https://www.meteojob.com/jobs/' || k::VARCHAR || '?a=1&b=2'", url_qualite="'construite'"))
def q_extract_meteojob(spark, d):
    html = _text('<a class="hotoffer-cta-link" style="x" href="https://www.meteojob.com/jobs/{n}?a=1&amp;b=2">Voir</a><p>{city} ({dept})'
                 " - {contract}</p>", n=F.col("k").cast("string"))
    return X.extract_meteojob_company(_singles(_cards(spark, d), _text("{company} recrute un {title}"), html, "meteojob_company"))


_LOGO = 'Logo"><strong title="'


@register("q_extract_jobijoba", _sql(
    "jobijoba_alerte", titre=f"CASE WHEN i = 2 THEN '{_LOGO}' || title ELSE title END", dept="''",
    salaire_min="(CASE WHEN i % 2 = 0 THEN 20000 + size * 100 ELSE (1500 + size * 10) * 12 END)::VARCHAR",
    salaire_max="(CASE WHEN i % 2 = 0 THEN 30000 + size * 100 ELSE (2500 + size * 10) * 12 END)::VARCHAR",
    url="'https://emails.jobijoba.com/clic/a-b/' || k::VARCHAR", url_qualite="'email'",
    notes="CASE WHEN i = 1 THEN '' ELSE 'Via Jobijoba (source' || i::VARCHAR || '.fr)' END"))
def q_extract_jobijoba(spark, d):
    """Two cards are paid by the month; one has a logo whose title runs into the offer's."""
    def amount(year: int, month: int) -> Column:
        n = F.when(F.col("i") % 2 == 0, F.lit(year) + F.col("size") * 100).otherwise(F.lit(month) + F.col("size") * 10).cast("string")
        return F.concat(F.substring(n, 1, 2), F.lit(" "), F.substring(n, F.lit(3), F.length(n)))

    euro = " <span itemprop='salaryCurrency'>€</span>"
    card = _text('<a class="c" href="https://emails.jobijoba.com/clic/a-b/{n}">{logo}<strong title="{title} - {platform}">{title}</strong>'
                 '<span>{city}</span><span style="color:#000000;x">{company}</span>{low}' + euro + " à {high}" + euro
                 + " {period}<i>{contract}</i></a>\n", n=F.col("k").cast("string"),
                 logo=F.when(F.col("i") == 2, F.lit('<img title="Logo">')).otherwise(F.lit("")),
                 platform=F.when(F.col("i") == 1, F.lit("jobijoba.com")).otherwise(F.concat(F.lit("source"), F.col("i").cast("string"), F.lit(".fr"))),
                 low=amount(20000, 1500), high=amount(30000, 2500),
                 period=F.when(F.col("i") % 2 == 0, F.lit("par an")).otherwise(F.lit("par mois")))
    return X.extract_jobijoba(_mails(_cards(spark, d), card, "jobijoba_alerte"))


@register("q_extract_talent", _sql(
    "talent_com", "i <> 3", titre="title || CASE WHEN contract = '' THEN '' ELSE ' - ' || contract END", dept="''",
    entreprise="CASE WHEN i = 4 THEN '' ELSE company END", ville="CASE WHEN i = 4 THEN '' ELSE city END",
    url="CASE WHEN i = 4 THEN '' ELSE 'https://fr.talent.com/redirect?id=' || lpad(k::VARCHAR, 8, '0') || '&p=2' END",
    url_qualite="CASE WHEN i = 4 THEN 'vide' ELSE 'email' END"))
def q_extract_talent(spark, d):
    """One anchor is a footer link; one offer has neither link nor place."""
    title = F.when(F.col("i") == 3, F.lit("Contactez-nous")).otherwise(
        F.concat("title", F.when(F.col("contract") == "", F.lit("")).otherwise(F.concat(F.lit(" - "), "contract"))))
    link = F.when(F.col("i") == 4, F.lit("https://fr.talent.com/view")).otherwise(
        F.concat(F.lit("https://fr.talent.com/redirect?id="), F.lpad(F.col("k").cast("string"), 8, "0"), F.lit("&amp;p=2")))
    cells = F.when(F.col("i") == 4, F.lit("")).otherwise(_text(
        '<tr><td style="x;color: #691f74">{city}, Région, France</td></tr><tr><td style="color:#30183f">{company}</td></tr>'))
    # the place is looked for in 2000 characters: so much stands between two cards
    card = _text('<a class="l" href="{link}">{title}</a><table>{cells}</table>' + NOISE * 2, link=link, title=title, cells=cells)
    return X.extract_talent_com(_mails(_cards(spark, d), card, "talent_com"))
