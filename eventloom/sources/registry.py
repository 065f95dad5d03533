"""Configured sources, and checks of the configuration."""

from __future__ import annotations

from dataclasses import astuple, dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .platforms import SCANS


@dataclass(frozen=True)
class Source:
    source_id: str
    adapter: str
    seed_url: str
    max_items: int = 100
    municipality: str | None = None
    enabled: bool = True
    timezone: str = "Europe/Zurich"


_CHURCH = "page=agenda&sucheDarstellung=agenda&sucheTyp=veranstaltungen&sucheZeitPunkt=today&sucheZeitFenster=365&sucheZielgruppe=Kinder"
#: The sources in use.
SOURCES = (
    Source("maennedorf_portal", "icms", "https://www.maennedorf.ch/anlaesseaktuelles", 200, "maennedorf"),
    Source("familienclub-herrliberg", "ai1ec", "https://familienclub-herrliberg.ch/agenda/", 500, "herrliberg"),
    Source("gemeinde-herrliberg", "govis", "https://www.herrliberg.ch/leben/freizeit/veranstaltungen.html/235", 200, "herrliberg", False),
    Source("meilen-portal", "icms", "https://www.meilen.ch/anlaesseaktuelles", 400, "meilen"),
    Source("zollikon-portal", "icms", "https://www.zollikon.ch/anlaesseaktuelles", 300, "zollikon"),
    Source("uetikon-portal", "icms", "https://www.uetikonamsee.ch/anlaesseaktuelles", 150, "uetikon"),
    Source("rapperswil-jona-portal", "icms", "https://www.rapperswil-jona.ch/anlaesseaktuelles", 300, "rapperswil-jona"),
    Source("ref-kirche-herrliberg", "kirchenweb", f"https://www.ref-herrliberg.ch/agenda?{_CHURCH}", 200, "herrliberg"),
    Source("kath-kirche-herrliberg", "kirchenweb", f"https://www.kath-herrliberg.ch/?{_CHURCH}", 100, "herrliberg"),
    Source("ref-kirche-meilen", "kirchenweb", f"https://www.ref-meilen.ch/agenda?{_CHURCH}", 200, "meilen"),
    Source("ref-staefa-hombrechtikon", "kirchenweb", "https://www.ref-staefa-hombrechtikon.ch/?page=agenda&sucheDarstellung=agenda&sucheTyp=veranstaltungen&sucheZielgruppe=Kinder", 200, "staefa"),
    Source("ref-kirche-zollikon-zumikon", "kirchenweb", f"https://www.ref-zozu.ch/?{_CHURCH}", 200, "zollikon"),
    Source("kath-kirche-zollikon-zumikon", "kirchenweb", f"https://www.kath-zollikon-zumikon.ch/?{_CHURCH}", 200, "zollikon"),
    Source("ref-kirche-kuesnacht", "kirchenweb", f"https://www.rkk.ch/?{_CHURCH}", 200, "kuesnacht"),
    Source("ref-kirche-erlenbach", "kirchenweb", f"https://www.ref-erlenbach.ch/?{_CHURCH}", 200, "erlenbach"),
    Source("ref-kirche-uetikon", "kirchenweb", f"https://www.ref-uetikon.ch/?{_CHURCH}", 200, "uetikon"),
    Source("kath-pfarrei-staefa", "kirchenweb", f"https://www.pfarreistaefa.ch/?{_CHURCH}", 200, "staefa"),
    Source("kath-pfarrei-hombrechtikon", "kirchenweb", f"https://www.pfarreistniklaus.ch/?{_CHURCH}", 200, "hombrechtikon"),
    Source("frauenverein-maennedorf", "contao", "https://www.frauenverein-maennedorf.ch/agenda.html", 50, "maennedorf"),
    Source("ref-kirche-maennedorf", "ics", "https://www.ref-maennedorf.ch/agenda/", 200, "maennedorf"),
    Source("fluugepilz-erlenbach", "rss", "https://www.xn--flgepilz-75aa.ch/events/feed/", 50, "erlenbach"),
    Source("familienclub-zollikon", "clubdesk", "https://www.familienclubzollikon.ch/clubdesk/www/familienclub?p=1000053", 50, "zollikon"),
    Source("zauberlaterne-maennedorf", "screenings", "https://www.lanterne-magique.org/de/clubs/mannedorf/", 20, "maennedorf"),
    Source("kuesnacht-portal", "govis", "https://www.kuesnacht.ch/leben-freizeit/veranstaltungen.page/843", 200, "kuesnacht"),
    Source("hombrechtikon-portal", "govis", "https://www.hombrechtikon.ch/leben/freizeit/veranstaltungskalender.html/228", 200, "hombrechtikon"),
    Source("familienzentrum-kuesnacht", "govis", "https://www.kuesnacht.ch/leben-freizeit/kinder-und-familien/familienzentrum.page/841", 50, "kuesnacht"),
    Source("forum-magazin-pfannenstiel", "forum", "https://www.forum-magazin.ch/agenda/", 100, None),
)


def validated(sources: tuple[Source, ...] = SOURCES) -> list[str]:
    """Warnings; raises ValueError for repeated ids and for enabled sources without a scan."""
    ids = [s.source_id for s in sources]
    if repeated := sorted({i for i in ids if ids.count(i) > 1}):
        raise ValueError(f"repeated sources: {repeated}")
    if missing := sorted({s.adapter for s in sources if s.enabled and s.adapter not in SCANS}):
        raise ValueError(f"no scan for: {missing}")
    return [f"{s.source_id}: no municipality" for s in sources if s.enabled and not s.municipality]


def table(spark: SparkSession, sources: tuple[Source, ...] = SOURCES) -> DataFrame:
    return spark.createDataFrame([astuple(s) for s in sources], "source_id string, adapter string, seed_url string, max_items int, municipality string, enabled boolean, timezone string").select(*[f.name for f in fields(Source)])


def with_municipality(rows: DataFrame, sources: tuple[Source, ...] = SOURCES) -> DataFrame:
    """Rows with their source's municipality; null for unknown sources. The configuration is small, a row a source."""
    known = table(rows.sparkSession, sources).select(F.col("source_id").alias("_s"), "municipality")
    return rows.join(F.broadcast(known), F.col("source_id") == F.col("_s"), "left").drop("_s")


def read(pages: DataFrame, sources: tuple[Source, ...] = SOURCES) -> DataFrame:
    """Items of all enabled sources from their captured pages, at most max_items a source.

    A scan reads the pages of all sources of its platform at once, so there are as many as platforms, and one quota follows for all.
    """
    from functools import reduce

    from ..operators.ordering import quota

    validated(sources)
    enabled = [s for s in sources if s.enabled]
    columns = ("source_id", "page", "pos", "item_url", "title_raw", "datetime_raw", "location_raw")
    found = []
    for adapter in sorted({s.adapter for s in enabled}):
        own = SCANS[adapter](pages.filter(pages["source_id"].isin(*[s.source_id for s in enabled if s.adapter == adapter])))
        found.append(own.select(*[c for c in columns if c in own.columns]))
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)
    limits = F.create_map(*[F.lit(x) for s in enabled for x in (s.source_id, s.max_items)])
    ranked = quota(every, ["source_id"], ["page", "pos"], max(s.max_items for s in enabled), keep="_n")
    return ranked.filter(F.col("_n") <= F.element_at(limits, F.col("source_id"))).drop("_n")
