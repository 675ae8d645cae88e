"""Data-quality rules: extraction with defensive casts, CHECK / NOT NULL /
FK / UNIQUE checks as accept/reject splits, and a DQ report.

The reference enforces these with triggers and constraints row by row.  Here
each rule is a column predicate; ``split`` returns (accepted, rejected)
DataFrames so a batch can be quarantined instead of failing, and
``mode='strict'`` turns any rejection into an error (the all-or-nothing
batch of the reference).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions.jsonops import DOCUMENT, document, has_value_at, text_at

VALID_STATUS = ("running", "completed", "failed")
INT_TEXT = r"^\s*[+-]?[0-9]+\s*$"
#: A whole ISO date or timestamp, nothing behind it.
DATE_TEXT = r"^\s*\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?\s*(Z|[+-]\d{2}(:?\d{2})?)?)?\s*$"


def split(df: DataFrame, ok: Column) -> tuple[DataFrame, DataFrame]:
    """(rows where ok is TRUE, rows where ok is FALSE or NULL)."""
    okc = F.coalesce(ok, F.lit(False))
    return df.filter(okc), df.filter(~okc)


def enforce(df: DataFrame, ok: Column, rule: str, mode: str = "quarantine") -> DataFrame:
    """Accepted rows; in strict mode any violation fails the batch."""
    good, bad = split(df, ok)
    if mode == "strict" and not bad.isEmpty():
        raise ValueError(f"constraint {rule} violated")
    return good


def lenient_int(text: Column) -> Column:
    """``text::int`` that yields NULL instead of raising ('4.5', 'five' → NULL)."""
    return F.when(text.rlike(INT_TEXT), (F.trim(text)).try_cast("int"))


def lenient_date(text: Column) -> Column:
    """``text::date`` for ISO dates/timestamps; anything else → NULL."""
    return F.when(text.rlike(DATE_TEXT), F.substring(F.trim(text), 1, 10).try_cast("date"))


REVIEW_DOC = "struct<reviewerName:string,stars:string,text:string,publishedAtDate:string>"


def extract_review_fields(raw: DataFrame, *more: str) -> DataFrame:
    """Typed review columns from ``review_data`` plus bad-value flags (and ``more`` columns as they are).

    One ``from_json`` parse per row with string leaves (a JSON number or
    string becomes its text, JSON null becomes NULL — the ``->>`` rule), then
    the defensive casts.
    """
    j = raw.select("id", "business_id", F.from_json("review_data", REVIEW_DOC).alias("_d"), *more)
    stars_txt, date_txt = F.col("_d.stars"), F.col("_d.publishedAtDate")
    stars = lenient_int(stars_txt)
    pub = lenient_date(date_txt)
    return j.select(
        "id", "business_id",
        F.col("_d.reviewerName").alias("reviewer_name"),
        stars.alias("stars"),
        F.col("_d.text").alias("review_text"),
        pub.alias("published_at"),
        (stars_txt.isNotNull() & stars.isNull()).alias("bad_stars"),
        (date_txt.isNotNull() & pub.isNull()).alias("bad_date"),
        *more,
    )


def stars_ok(stars: Column) -> Column:
    """CHECK (stars IS NULL OR stars BETWEEN 0 AND 5)."""
    return stars.isNull() | stars.between(0, 5)


def validate_stars(extracted: DataFrame) -> DataFrame:
    """Rejected rows of the stars range check."""
    return split(extracted, stars_ok(F.col("stars")))[1].select("id", "business_id", "stars")


def validate_status(executions: DataFrame) -> DataFrame:
    """Runs whose status is outside the enum."""
    return split(executions, F.col("status").isin(*VALID_STATUS))[1].select("id", "status")


def validate_not_null(businesses: DataFrame) -> DataFrame:
    """NOT NULL on name, document and run id; names what is missing."""
    needed = ("business_name", "business_data", "execution_id")
    missing = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in needed])
    return businesses.select("id", missing.alias("missing")).filter(F.col("missing") != "")


def fk_orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str = "id") -> DataFrame:
    """Child rows whose foreign key has no parent (anti-join)."""
    return child.join(parent.select(F.col(pk).alias(fk)), fk, "left_anti")


def unique_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values occurring more than once; NULL keys are exempt."""
    nn = None
    for k in keys:
        c = F.col(k).isNotNull()
        nn = c if nn is None else nn & c
    return (df.filter(nn).groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences"))
            .filter(F.col("occurrences") > 1))


BUSINESS_DOC = ("struct<overview:struct<city:string,category:string>,"
                "rating:struct<totalScore:string,reviewsCount:string>,"
                "contact:struct<website:string,phone:string>>")


def _generated_exprs(businesses: DataFrame, strict: bool = False) -> dict[str, Column]:
    """The six generated columns: fields of the stored VARIANT, or one ``from_json`` parse where there is only text."""
    if DOCUMENT in businesses.columns:
        at = lambda *path: text_at(F.col(DOCUMENT), *path)
    else:
        d = F.from_json(F.col("business_data"), BUSINESS_DOC)
        at = lambda part, name: d[part][name]
    cast = (lambda c, t: c.cast(t)) if strict else (lambda c, t: c.try_cast(t))
    return {
        "city": at("overview", "city"),
        "category": at("overview", "category"),
        "rating": cast(at("rating", "totalScore"), "decimal(3,1)"),
        "review_count": cast(at("rating", "reviewsCount"), "int"),
        "website": at("contact", "website"),
        "phone": at("contact", "phone"),
    }


def generated_columns(businesses: DataFrame, strict: bool = False) -> DataFrame:
    """The six stored columns re-derived from the document."""
    return businesses.select("id", *[c.alias(k) for k, c in _generated_exprs(businesses, strict).items()])


def dq_report(businesses: DataFrame, extracted_reviews: DataFrame) -> DataFrame:
    """(rule, value) rows of rule counts (count_if per rule)."""
    gen = _generated_exprs(businesses)
    doc = document(businesses)
    j = businesses.select("city", "rating", "business_data", "business_name",
                          *[has_value_at(doc, k).alias("has_" + k) for k in ("overview", "rating", "contact")],
                          *[F.col(k).eqNullSafe(c).alias("eq_" + k) for k, c in gen.items()])
    mism = None
    for c in ("city", "category", "rating", "review_count", "website", "phone"):
        m = ~F.col("eq_" + c)
        mism = m if mism is None else mism | m
    missing_keys = ~F.col("has_overview") | ~F.col("has_rating") | ~F.col("has_contact")
    brep = j.agg(
        F.count(F.lit(1)).alias("businesses"),
        F.count_if(mism).alias("generated_mismatch"),
        F.count_if(missing_keys).alias("missing_required_keys"),
        F.count_if(F.col("city").isNotNull()).alias("populated_city"),
        F.count_if(F.col("rating").isNotNull()).alias("populated_rating"),
        F.count_if(F.col("business_name").isNull() | F.col("business_data").isNull()).alias("null_required"),
    )
    rrep = extracted_reviews.agg(*[c.alias(rule) for rule, c in review_warnings().items()])
    return _long(brep).unionByName(_long(rrep))


def review_warnings() -> dict[str, Column]:
    """The review rules of :func:`dq_report` as aggregates over extracted reviews."""
    return {"reviews": F.count(F.lit(1)), "bad_stars": F.count_if(F.col("bad_stars")), "bad_date": F.count_if(F.col("bad_date")),
            "stars_out_of_range": F.count_if(~stars_ok(F.col("stars")))}


def dq_rows(raw: DataFrame) -> DataFrame:
    """The reviews behind the counts: (rule, id, business_id, reviewer_name, value)."""
    j = raw.select("id", "business_id", F.from_json("review_data", REVIEW_DOC).alias("_d"))
    stars_txt, date_txt = F.col("_d.stars"), F.col("_d.publishedAtDate")
    stars = lenient_int(stars_txt)
    found = F.array(
        F.when(stars_txt.isNotNull() & stars.isNull(), F.struct(F.lit("bad_stars").alias("rule"), stars_txt.alias("value"))),
        F.when(date_txt.isNotNull() & lenient_date(date_txt).isNull(), F.struct(F.lit("bad_date").alias("rule"), date_txt.alias("value"))),
        F.when(~stars_ok(stars), F.struct(F.lit("stars_out_of_range").alias("rule"), stars_txt.alias("value"))))
    each = j.select("id", "business_id", F.col("_d.reviewerName").alias("reviewer_name"), F.explode(F.array_compact(found)).alias("f"))
    return each.select("f.rule", "id", "business_id", "reviewer_name", "f.value")


def _long(one_row: DataFrame) -> DataFrame:
    """Unpivot a one-row aggregate into (rule, value) rows."""
    cols = one_row.columns
    return one_row.unpivot([], [F.col(c).cast("bigint").alias(c) for c in cols], "rule", "value")
