"""Articles out of listing pages: HTML with a ``var listing = {...};`` script."""

from pyspark.sql import functions as F

from newsloom.functions.markup import html_text, location_of
from newsloom.schemas import CUSTOM_FIELDS_SCHEMA, LISTING_SCHEMA

NO_SUMMARY = "Summary not available."
NOT_GIVEN = "N/A"
# The lazy match stops at the first "};", as the site's own pages need no more. (?d): only "\n" ends a
# line, or a page with another line separator in a title would not match.
LISTING_MARK = "var listing = "
LISTING_PATTERN = r"(?d)var listing = (\{.*?\});"
_ITEM_SCHEMA = LISTING_SCHEMA["data"].dataType.elementType


def listing_urls(days, template="https://news.example.com/nation?sdate={0}&edate={0}"):
    """One listing URL per row of ``days`` (column ``day``)."""
    before, middle, after = template.split("{0}")
    text = F.date_format("day", "yyyy-MM-dd")
    return days.select("day", F.concat(F.lit(before), text, F.lit(middle), text, F.lit(after)).alias("url"))


def last_days(df, end, count):
    """``day`` rows from ``end`` back over ``count`` days; both are columns of the one-row ``df``."""
    first = F.date_sub(end, count - 1)
    return df.select(F.explode(F.sequence(end, first, F.expr("interval -1 day"))).alias("day"))


def _parsed(pages):
    """Pages that carry a listing script, with the script's JSON text and its items as JSON texts."""
    script = F.regexp_extract("html", LISTING_PATTERN, 1)
    return (
        pages.filter(F.contains("html", F.lit(LISTING_MARK)))
        .withColumn("listing_json", script)
        .withColumn("listing", F.from_json("listing_json", "data array<string>"))
    )


def extract_listing(pages, base_url="https://news.example.com/"):
    """Article rows of ``pages`` (column ``html``). Pages without a script give none.

    A section, sub-section or keyword list that an item lacks takes its default; a null that it holds stays null.
    """
    article = F.col("article")

    def given(name, default):
        return F.when(F.array_contains("names", name), article[name]).otherwise(default)

    custom = F.from_json(article["article_custom_fields"], CUSTOM_FIELDS_SCHEMA)
    return (
        _parsed(pages)
        .select(F.explode("listing.data").alias("item"))
        .select(F.from_json("item", _ITEM_SCHEMA).alias("article"), F.json_object_keys("item").alias("names"))
        .select(
            article["article_title"].alias("title"),
            F.concat(F.lit(base_url), article["permalink"]).alias("link"),
            F.coalesce(F.get(custom["summary"], F.lit(0)), F.lit(NO_SUMMARY)).alias("summary"),
            article["publish_time"].alias("publish_time"),
            given("section_name", F.lit(NOT_GIVEN)).alias("section"),
            given("sub_section_name", F.lit(NOT_GIVEN)).alias("sub_section"),
            given("keyword_tagging", F.array().cast("array<string>")).alias("keywords"),
            html_text(article["article_body"]).alias("body"),
        )
        .withColumn("location", location_of(F.col("body")))
    )


def listing_rejects(pages):
    """Pages whose listing script is not found whole or does not parse."""
    return _parsed(pages).filter(F.col("listing.data").isNull()).drop("listing")


def page_texts(pages):
    return pages.select("page_id", html_text(F.col("html")).alias("text"))
