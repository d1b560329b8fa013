"""Raw catalog rows to typed products, with every problem of every rejected row."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweave.functions import identity, money, text
from stockweave.operators.quality import category_counts
from stockweave.operators.shape import fixed
from stockweave.schemas import CATEGORIES, CLEAN_PRODUCT, RAW_COLUMNS

# Category aliases, the image path pattern and text limits.
CATEGORY_ALIASES = {
    "men's clothing": "men",
    "mens": "men",
    "men's": "men",
    "women's clothing": "women",
    "womens": "women",
    "women's": "women",
    "kids wear": "kids",
    "children": "kids",
    "kids'": "kids",
    "accessory": "accessories",
    "shoes": "footwear",
}
IMAGE_PATH = r"\A/assets/images/[a-z0-9][a-z0-9_.-]*\.(?:jpg|jpeg|png|webp|avif)\z"
TEXT_LIMITS = {"name": 120, "description": 2000, "alt": 300}
# Problem texts.
CONTROL_PROBLEM = "contains an unsupported control character"
WIDTH_PROBLEM = "row has the wrong number of CSV fields"
ID_PROBLEM = "id must be 3-64 lowercase letters, digits or single hyphens"
DUPLICATE_PROBLEM = "duplicate id; all rows with this id are rejected"
CATEGORY_PROBLEM = "category is not one of the five supported categories"
IMAGE_PATH_PROBLEM = "image must be a local /assets/images/ filename"
IMAGE_FILE_PROBLEM = "image file is missing (filename case must match exactly)"
FLAG_PROBLEM = "featured must be 0/1, true/false or yes/no"
EMPTY_PROBLEM = "catalog must contain at least one product"

PRODUCT_FIELDS = tuple(CLEAN_PRODUCT.fieldNames())


def canonical_category(c) -> Column:
    """One of the five categories, or the normalised text when it is none of them."""
    plain = F.replace(F.lower(text.squash(text.blank_if_null(c))), F.lit("’"), F.lit("'"))
    aliases = F.create_map(*[F.lit(x) for pair in CATEGORY_ALIASES.items() for x in pair])
    return F.coalesce(F.try_element_at(aliases, plain), plain)


@dataclass(frozen=True)
class CleanCatalog:
    """`evaluated` has one row per input row; the rest are lazy views of it."""

    evaluated: DataFrame

    @property
    def accepted(self) -> DataFrame:
        """Typed products sorted by id."""
        good = self.evaluated.filter(F.size("problems") == 0)
        return good.select(*[F.col("product." + f).alias(f) for f in PRODUCT_FIELDS]).orderBy("id")

    @property
    def place(self) -> list[str]:
        """The file that `row` counts in, where the rows come from files."""
        return [c for c in self.evaluated.columns if c == "input_file"]

    @property
    def issues(self) -> DataFrame:
        """Rejected rows with all their problems in rule order."""
        bad = self.evaluated.filter(F.size("problems") > 0)
        return bad.select(*self.place, "row", F.col("product.id").alias("id"), F.col("problems").alias("errors"))

    @property
    def normalizations(self) -> DataFrame:
        """Fields of accepted rows whose cleaned text is not the raw text."""
        product = F.col("product")
        cleaned = {f: product[f] for f in RAW_COLUMNS if f not in ("price_inr", "sizes", "colors", "featured")}
        cleaned["price_inr"] = product["price_minor"].cast("string")
        cleaned["sizes"] = F.array_join(product["sizes"], "|")
        cleaned["colors"] = F.array_join(product["colors"], "|")
        cleaned["featured"] = product["featured"].cast("int").cast("string")
        pairs = F.array(
            *[
                F.struct(
                    F.lit(f).alias("field"),
                    cleaned[f].alias("result"),
                    text.blank_if_null(F.col("raw")[f]).alias("was"),
                )
                for f in RAW_COLUMNS
            ]
        )
        changed = F.filter(pairs, lambda p: p["result"] != p["was"])
        good = self.evaluated.filter(F.size("problems") == 0)
        exploded = good.select(*self.place, "row", F.col("product.id").alias("id"), F.explode(changed).alias("change"))
        return exploded.select(*self.place, "row", "id", "change.field", "change.result")

    @property
    def summary(self) -> DataFrame:
        return quality_summary(self.evaluated)

    @property
    def category_counts(self) -> DataFrame:
        return category_counts(self.accepted)


def quality_summary(evaluated: DataFrame) -> DataFrame:
    """One row: input, accepted and rejected rows; an empty input fails too."""
    accepted = F.count_if(F.size("problems") == 0)
    return evaluated.agg(
        F.count("*").alias("input_rows"),
        accepted.alias("accepted_rows"),
        (F.count("*") - accepted).alias("rejected_rows"),
        F.when((F.count("*") > 0) & (accepted == F.count("*")), F.lit("passed"))
        .otherwise(F.lit("failed"))
        .alias("status"),
    )


def _problems(repeated: Column, has_file: Column, ragged: Column) -> Column:
    raw, clean, product = F.col("raw"), F.col("text"), F.col("product")
    checks = [
        F.when(raw[f].rlike(text.CONTROL), F.lit(f"{f} {CONTROL_PROBLEM}")) for f in RAW_COLUMNS
    ]
    short = ragged
    for f in RAW_COLUMNS:
        short = short | raw[f].isNull()
    checks += [
        F.when(short, F.lit(WIDTH_PROBLEM)),
        F.when(~identity.catalog_id_valid(product["id"]), F.lit(ID_PROBLEM)),
        F.when(repeated, F.lit(DUPLICATE_PROBLEM)),
        F.when(~product["category"].isin(*CATEGORIES), F.lit(CATEGORY_PROBLEM)),
    ]
    for f, limit in TEXT_LIMITS.items():
        checks.append(
            F.when(~F.length(clean[f]).between(1, limit), F.lit(f"{f} must contain 1-{limit} characters"))
        )
    checks += [
        money.price_text_problem(clean["price_inr"]),
        F.when(~product["image"].rlike(IMAGE_PATH), F.lit(IMAGE_PATH_PROBLEM)).when(
            ~has_file, F.lit(IMAGE_FILE_PROBLEM)
        ),
        text.labels_problem(clean["sizes"], product["sizes"], "sizes"),
        text.labels_problem(clean["colors"], product["colors"], "colors"),
        F.when(product["featured"].isNull(), F.lit(FLAG_PROBLEM)),
    ]
    return text.present(*checks)


def clean_catalog(raw: DataFrame, image_files: DataFrame) -> CleanCatalog:
    """Evaluate all rules on `raw` (the raw text columns, `row`, optionally `ragged`).

    `image_files` lists existing file names in a column `name`. Ids are counted
    after a map-side partial count; only repeated ids meet the rows again.
    """
    ragged = F.col("ragged") if "ragged" in raw.columns else F.lit(False)
    place = [c for c in raw.columns if c == "input_file"]
    rows = raw.select(
        *place,
        "row",
        F.struct(*RAW_COLUMNS).alias("raw"),
        F.struct(*[text.squash(text.blank_if_null(f)).alias(f) for f in RAW_COLUMNS]).alias("text"),
        F.lower(text.strip(text.blank_if_null("id"))).alias("_counted_id"),
        ragged.alias("_ragged"),
    )
    t = F.col("text")
    rows = rows.withColumn(
        "product",
        F.struct(
            F.lower(t["id"]).alias("id"),
            t["name"].alias("name"),
            canonical_category(t["category"]).alias("category"),
            t["description"].alias("description"),
            money.price_text_to_paise(t["price_inr"]).alias("price_minor"),
            F.lower(t["image"]).alias("image"),
            t["alt"].alias("alt"),
            text.labels(t["sizes"]).alias("sizes"),
            text.labels(t["colors"]).alias("colors"),
            text.flag(t["featured"]).alias("featured"),
        ),
    )
    repeated = (
        rows.groupBy("_counted_id").agg(F.count("*").alias("_n")).filter("_n > 1")
        .select(F.col("_counted_id").alias("_repeated_id"))
    )
    files = image_files.select(F.col("name").alias("_file")).distinct()
    joined = rows.join(repeated, F.col("product.id") == F.col("_repeated_id"), "left").join(
        files, F.substring_index("product.image", "/", -1) == F.col("_file"), "left"
    )
    problems = _problems(F.col("_repeated_id").isNotNull(), F.col("_file").isNotNull(), F.col("_ragged"))
    return CleanCatalog(fixed(joined, [*place, "row", "raw", "product"], {"problems": problems}))


def issue_log(clean: CleanCatalog) -> DataFrame:
    """Row issues, and the file-level issue of a catalog without rows."""
    empty = clean.summary.filter("input_rows = 0").select(
        F.lit(1).cast("bigint").alias("row"), F.lit("").alias("id"), F.array(F.lit(EMPTY_PROBLEM)).alias("errors")
    )
    rows = clean.issues.select(*clean.place, F.col("row").cast("bigint"), "id", "errors")
    return rows.unionByName(empty, allowMissingColumns=True)
