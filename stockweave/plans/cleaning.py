"""Catalog cleaning over raw texts written from the part table."""

from __future__ import annotations

from pyspark.sql import functions as F

from stockweave.operators import cleaning as L
from stockweave.sources.tables import load_spread, load_table

# The same expressions in both dialects: texts as retailers send them, with every
# kind of bad row. A seventeenth of the rows shares one id.
_RAW = {
    "row": "p_partkey + 2",
    "id": """CASE WHEN p_partkey % 17 = 0 THEN 'part-dup' WHEN p_partkey % 13 = 0 THEN 'part_' || K
        WHEN p_partkey % 11 = 0 THEN ' PART-' || K || ' ' ELSE 'part-' || K END""",
    "name": "CASE WHEN p_partkey % 7 = 0 THEN '  ' || p_name || '   set ' ELSE p_name END",
    "category": """CASE WHEN p_partkey % 19 = 0 THEN 'appliances' WHEN p_type = 'STANDARD' THEN ' Men’s Clothing '
        WHEN p_type = 'PROMO' THEN 'WOMENS' WHEN p_type = 'SMALL' THEN 'Kids  Wear'
        WHEN p_type = 'ECONOMY' THEN 'accessory' ELSE 'footwear' END""",
    "description": "CASE WHEN p_partkey % 23 = 0 THEN ' ' ELSE 'Made by ' || p_brand END",
    "price_inr": """CASE p_partkey % 8
        WHEN 0 THEN '₹' || substr(R, 1, 3) || ',' || substr(R, 4) || '.' || P
        WHEN 1 THEN 'INR ' || substr(R, 1, 1) || ',' || substr(R, 2, 2) || ',' || substr(R, 4) || '.' || P
        WHEN 2 THEN R
        WHEN 3 THEN R || '.' || P
        WHEN 4 THEN substr(R, 1, 4) || ',' || substr(R, 5)
        WHEN 5 THEN R || '.' || P || '5'
        WHEN 6 THEN 'inr' || R
        ELSE R || '00.' || P END""",
    "image": """CASE WHEN p_partkey % 31 = 0 THEN 'https://cdn.example/' || K || '.webp'
        WHEN p_partkey % 37 = 0 THEN '/assets/images/none.webp'
        ELSE '/assets/images/' || upper(replace(p_name, ' ', '-')) || '.webp' END""",
    "alt": "p_name || ' photo'",
    "sizes": """CASE WHEN p_partkey % 29 = 0 THEN repeat('x', 41) || '|S' WHEN p_partkey % 4 = 0 THEN ''
        WHEN p_partkey % 4 = 1 THEN 'S|M|m|L' ELSE ' S | M ||' END""",
    "colors": "W || '|' || upper(W)",
    "featured": """CASE WHEN p_partkey % 41 = 0 THEN 'maybe' WHEN p_partkey % 5 = 0 THEN 'YES'
        WHEN p_partkey % 5 = 1 THEN '1' ELSE 'false' END""",
}
_INNER = """SELECT *, CAST(p_partkey AS {text}) AS K, {word} AS W,
    CAST(minor {div} 100 AS {text}) AS R, lpad(CAST(minor % 100 AS {text}), 2, '0') AS P
    FROM (SELECT *, CAST(round(p_retailprice * 100) AS BIGINT) * 137 AS minor FROM {source}) t"""


def raw_parts(spark, d):
    part = load_spread(spark, d, "part")
    inner = _INNER.format(text="STRING", word="substring_index(p_name, ' ', 1)", div="DIV", source="{part}")
    columns = ", ".join(f"{expression} AS {name}" for name, expression in _RAW.items())
    return spark.sql(f"SELECT {columns} FROM ({inner}) u", part=part)


def _clean(spark, d):
    # every part has its photo on file
    names = load_table(spark, d, "part").select(
        F.concat(F.replace("p_name", F.lit(" "), F.lit("-")), F.lit(".webp")).alias("name")
    )
    return L.clean_catalog(raw_parts(spark, d), names)


def clean_parts(spark, d):
    accepted = _clean(spark, d).accepted
    return accepted.withColumns({c: F.array_join(c, "|") for c in ("sizes", "colors")})


def clean_issues(spark, d):
    issues = L.issue_log(_clean(spark, d))
    return issues.select("row", "id", F.array_join("errors", "; ").alias("errors"))


def normalization_log(spark, d):
    return _clean(spark, d).normalizations


def quality_summary(spark, d):
    return _clean(spark, d).summary


def clean_category_counts(spark, d):
    return _clean(spark, d).category_counts


QUERIES = {
    "clean_parts": clean_parts,
    "clean_issues": clean_issues,
    "normalization_log": normalization_log,
    "quality_summary": quality_summary,
    "clean_category_counts": clean_category_counts,
}


def _squash(c: str) -> str:
    return f"trim(regexp_replace({c}, '\\s+', ' ', 'g'))"


def _labels(c: str) -> str:
    parts = f"list_filter(list_transform(string_split({c}, '|'), lambda x: {_squash('x')}), lambda x: x <> '')"
    folded = f"list_transform({parts}, lambda x: lower(x))"
    return f"list_filter({parts}, lambda x, i: list_position({folded}, lower(x)) = i)"


_INNER_SQL = _INNER.format(text="VARCHAR", word="split_part(p_name, ' ', 1)", div="//", source="part")
_RAW_SQL = ", ".join(f"{e} AS {n}" if n != "row" else f'{e} AS "row"' for n, e in _RAW.items())
_CLEAN_SQL = rf"""WITH raw AS (SELECT {_RAW_SQL} FROM ({_INNER_SQL}) u),
t AS (SELECT "row", raw AS was, lower({_squash('id')}) AS id, {_squash('name')} AS name,
    {_squash('description')} AS description, {_squash('alt')} AS alt, lower({_squash('image')}) AS image,
    lower(replace({_squash('category')}, '’', '''')) AS cat, lower({_squash('featured')}) AS flag,
    regexp_replace({_squash('price_inr')}, '^(?:INR\s*|₹\s*)', '', 'i') AS bare,
    {_labels('sizes')} AS sizes, {_labels('colors')} AS colors,
    len(list_filter(string_split(sizes, '|'), lambda x: len({_squash('x')}) > 40)) AS long_sizes,
    count(*) OVER (PARTITION BY lower(trim(id))) AS copies FROM raw),
v AS (SELECT *, CASE cat WHEN 'men''s clothing' THEN 'men' WHEN 'womens' THEN 'women' WHEN 'kids wear' THEN 'kids'
        WHEN 'accessory' THEN 'accessories' ELSE cat END AS category,
    regexp_full_match(bare, '(?:\d+|\d{{1,3}}(?:,\d{{3}})+|\d{{1,2}}(?:,\d{{2}})*,\d{{3}})(?:\.\d{{1,2}})?') AS well,
    CASE WHEN well THEN CAST(CAST(replace(bare, ',', '') AS DECIMAL(20,2)) * 100 AS BIGINT) END AS amount,
    CASE WHEN flag IN ('1','true','yes') THEN true WHEN flag IN ('0','false','no') THEN false END AS featured FROM t),
e AS (SELECT *, list_filter([
    CASE WHEN NOT regexp_full_match(id, '[a-z0-9]+(?:-[a-z0-9]+)*') OR len(id) NOT BETWEEN 3 AND 64
        THEN 'id must be 3-64 lowercase letters, digits or single hyphens' END,
    CASE WHEN copies > 1 THEN 'duplicate id; all rows with this id are rejected' END,
    CASE WHEN category NOT IN ('men','women','kids','accessories','footwear')
        THEN 'category is not one of the five supported categories' END,
    CASE WHEN len(name) NOT BETWEEN 1 AND 120 THEN 'name must contain 1-120 characters' END,
    CASE WHEN len(description) NOT BETWEEN 1 AND 2000 THEN 'description must contain 1-2000 characters' END,
    CASE WHEN len(alt) NOT BETWEEN 1 AND 300 THEN 'alt must contain 1-300 characters' END,
    CASE WHEN NOT well THEN 'price must be a positive INR amount with at most two decimal places'
        WHEN amount NOT BETWEEN 1 AND 100000000 THEN 'price must be between INR 0.01 and INR 1000000.00' END,
    CASE WHEN NOT regexp_full_match(image, '/assets/images/[a-z0-9][a-z0-9_.-]*\.(?:jpg|jpeg|png|webp|avif)')
            THEN 'image must be a local /assets/images/ filename'
        WHEN NOT split_part(image, '/', 4) IN (SELECT replace(p_name, ' ', '-') || '.webp' FROM part)
            THEN 'image file is missing (filename case must match exactly)' END,
    CASE WHEN long_sizes > 0 THEN 'sizes contains an invalid option' END,
    CASE WHEN featured IS NULL THEN 'featured must be 0/1, true/false or yes/no' END
    ], lambda x: x IS NOT NULL) AS problems FROM v) """

ORACLE = {
    "clean_parts": _CLEAN_SQL + """SELECT id, name, category, description, amount AS price_minor, image, alt,
        array_to_string(sizes, '|') AS sizes, array_to_string(colors, '|') AS colors, featured
        FROM e WHERE len(problems) = 0""",
    "clean_issues": _CLEAN_SQL + """SELECT "row", id, array_to_string(problems, '; ') AS errors
        FROM e WHERE len(problems) > 0""",
    "normalization_log": _CLEAN_SQL + """, n AS (SELECT "row", id, unnest([
            {'field': 'id', 'result': id, 'was': was.id},
            {'field': 'name', 'result': name, 'was': was.name},
            {'field': 'category', 'result': category, 'was': was.category},
            {'field': 'description', 'result': description, 'was': was.description},
            {'field': 'price_inr', 'result': CAST(amount AS VARCHAR), 'was': was.price_inr},
            {'field': 'image', 'result': image, 'was': was.image},
            {'field': 'alt', 'result': alt, 'was': was.alt},
            {'field': 'sizes', 'result': array_to_string(sizes, '|'), 'was': was.sizes},
            {'field': 'colors', 'result': array_to_string(colors, '|'), 'was': was.colors},
            {'field': 'featured', 'result': CASE WHEN featured THEN '1' ELSE '0' END, 'was': was.featured}]) AS f
            FROM e WHERE len(problems) = 0)
        SELECT "row", id, f.field AS field, f.result AS result FROM n WHERE f.result <> f.was""",
    "quality_summary": _CLEAN_SQL + """SELECT count(*) AS input_rows,
        count(*) FILTER (len(problems) = 0) AS accepted_rows, count(*) FILTER (len(problems) > 0) AS rejected_rows,
        CASE WHEN count(*) > 0 AND count(*) FILTER (len(problems) > 0) = 0 THEN 'passed' ELSE 'failed' END AS status
        FROM e""",
    "clean_category_counts": _CLEAN_SQL + """SELECT category, count(*) AS products FROM e
        WHERE len(problems) = 0 GROUP BY category""",
}
