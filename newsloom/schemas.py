"""Row shapes shared by the sources, the operators and the streams."""

from pyspark.sql import types as T

ARTICLE_SCHEMA = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("link", T.StringType()),
        T.StructField("summary", T.StringType()),
        T.StructField("publish_time", T.StringType()),
        T.StructField("section", T.StringType()),
        T.StructField("sub_section", T.StringType()),
        T.StructField("keywords", T.ArrayType(T.StringType())),
        T.StructField("location", T.StringType()),
        T.StructField("body", T.StringType()),
    ]
)

# One article as it stands inside a listing page's script.
LISTING_SCHEMA = T.StructType(
    [
        T.StructField(
            "data",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("article_title", T.StringType()),
                        T.StructField("permalink", T.StringType()),
                        T.StructField("publish_time", T.StringType()),
                        T.StructField("article_custom_fields", T.StringType()),
                        T.StructField("article_body", T.StringType()),
                        T.StructField("section_name", T.StringType()),
                        T.StructField("sub_section_name", T.StringType()),
                        T.StructField("keyword_tagging", T.ArrayType(T.StringType())),
                    ]
                )
            ),
        )
    ]
)

CUSTOM_FIELDS_SCHEMA = T.StructType([T.StructField("summary", T.ArrayType(T.StringType()))])

LEXICON_SCHEMA = T.StructType(
    [T.StructField("token", T.StringType()), T.StructField("valence", T.DoubleType())]
)

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

LABELS = ("positive", "neutral", "negative")

RESULT_COLUMNS = (
    "title",
    "summary",
    "publish_time",
    "section",
    "sub_section",
    "keywords",
    "location",
    "predicted_label",
)
