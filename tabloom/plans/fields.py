"""Field extraction from documents written out of the customer table.

Each customer becomes one document in one of four formats. The SQL does
not parse anything: it states the values that were written into the text.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.functions import fields, values
from tabloom.operators import export, profile
from tabloom.plans import Query
from tabloom.session import load, scratch_dir, spread

_MINUTE = "(10 + c_nationkey)"
_SECOND = "(c_custkey % 60 + 0.25)"
_REPORT = """concat('Incident Report', chr(10), 'Well Operator : Oasis Petroleum ', c_nationkey, chr(10),
 'Well or Facility Name: STATE ', c_custkey, '-1H', chr(10), 'NDIC File Number: ', c_custkey + 500000, chr(10),
 'Field Name: Sand Creek', chr(10), 'County: Dunn ', chr(10), 'Section: ', c_nationkey + 1, chr(10), 'Township: 150N', chr(10),
 'Range : 98W', chr(10), 'API No: 33 053 ', lpad(CAST(c_custkey AS VARCHAR(20)), 5, '0'), chr(10), 'Surface N 48° ', {minute}, ''' ', {second},
 '"  W 103° ', {minute}, ''' 15.5"', chr(10), 'Bottom N 49° 1'' 1"')"""
_SURVEY = """concat('Survey certification', chr(10), 'API # 33-105-', lpad(CAST(c_custkey AS VARCHAR(20)), 5, '0'), chr(10),
 'at 12° 01'' 01" N and 48° ', {minute}, ''' ', {second}, '" N , 102° ', {minute}, ''' 20" W')"""
_FORM = """concat('Well Name and Number Spacing', chr(10), 'BIG HORN ', c_custkey, 'H', chr(10), 'Operator Telephone Number', chr(10),
 'Nobody', chr(10), 'Operator', chr(10), '  Continental Resources Inc', chr(10), 'Qtr SESE ', c_nationkey, ' 151 N 99 W', chr(10),
 'Williams County', chr(10), 'Field', chr(10), 'BAKER CREEK', chr(10), 'Latitude: 47.', 100000 + c_custkey, ' Longitude = -102.654321',
 chr(10), 'Well Specific Stimulations', chr(10), 'Date Stimulated Top (Ft) Bottom (Ft)', chr(10), '9/9 Middle Bakken ',
 10000 + c_nationkey, ' ', 20000 + c_nationkey, chr(10), 'Type Sand Frac  Stimulation Stages: ', c_nationkey, chr(10),
 120000 + c_custkey, ' Barrels', chr(10), 'Lbs Proppant: 4,500,0', c_nationkey, chr(10), 'Maximum Treatment Pressure (PSI): 9,1',
 c_nationkey, chr(10), 'Maximum Treatment Rate (BBLS/Min): 70.5', chr(10), 'CORES CUT none 99999 PSI')"""
_APPROVAL = """concat('Well Name Inspector', chr(10), 'FOX ', c_custkey, '-2H Smith', chr(10), 'OPERATOR', chr(10),
 'Operator Representative Phone', chr(10), 'HESS BAKKEN COMPANY', chr(10), 'Field', chr(10), '500 Feet N', chr(10),
 'LITTLE KNIFE', chr(10), c_nationkey, '-150N-98W')"""


def _documents(spark, folder):
    number = {"minute": _MINUTE, "second": _SECOND}
    text = (
        f"CASE WHEN c_nationkey < 7 THEN {_REPORT.format(**number)} WHEN c_nationkey < 12 THEN {_SURVEY.format(**number)} "
        f"WHEN c_nationkey < 19 THEN {_FORM} ELSE {_APPROVAL} END"
    )
    name = "CASE WHEN c_mktsegment = 'BUILDING' THEN 'scan.pdf' ELSE concat('W', c_custkey, '.pdf') END"
    return spread(load(spark, folder, "customer")).select(
        "c_custkey", F.expr(text).alias("text"), F.expr(name).alias("filename")
    )


def well_extract(spark, folder):
    wells = fields.extract_wells(_documents(spark, folder))
    return wells.drop("text", "filename", "text_length").withColumns(
        {c: F.round(c, 6) for c in ("latitude", "longitude")}
    )


def stim_extract(spark, folder):
    return fields.extract_treatments(_documents(spark, folder)).drop("text", "filename")


def extraction_counts(spark, folder):
    return profile.extraction_counts(fields.extract_documents(_documents(spark, folder)))


def cleaned_wells(spark, folder):
    wells = fields.extract_wells(_documents(spark, folder)).withColumns({
        "well_status": F.expr("concat('<b>Act</b>ive é  ', c_custkey % 3)"), "well_type": F.lit(None).cast("string"),
        "closest_city": F.expr("concat('City ', c_custkey)"), "oil_produced": F.lit(""), "gas_produced": F.expr("concat(c_custkey, ' MCF ')"),
    })
    columns = [*fields.WELL_FIELDS, "well_status", "well_type", "closest_city", "oil_produced", "gas_produced"]
    return fields.clean_wells(wells, columns).select(
        "c_custkey", *columns, F.col("latitude").cast("double").alias("latitude"), F.col("longitude").cast("double").alias("longitude")
    )


def cleaned_treatments(spark, folder):
    return fields.clean_treatments(fields.extract_treatments(_documents(spark, folder))).select(
        "c_custkey", *fields.TREATMENT_FIELDS
    )


def coordinates(spark, folder):
    """Degrees from order dates, in three notations."""
    text = """CASE WHEN o_orderstatus = 'F' THEN concat('Lat N 47° ', month(o_orderdate), ''' ', day(o_orderdate), '.5" W 101 ° ', day(o_orderdate), '’ ', month(o_orderdate), '”')
      WHEN o_orderstatus = 'O' THEN concat('bad 99° 00'' 00" N, 46º ', month(o_orderdate), '′ ', day(o_orderdate), '.5″ N 105˚', day(o_orderdate), '′', month(o_orderdate), '″w')
      ELSE concat('Latitude 12.3456 Lat: 48.', 1000 + day(o_orderdate), ' Lon=-104.', 1000 + month(o_orderdate)) END"""
    rows = load(spark, folder, "orders").select("o_orderkey", F.expr(text).alias("text"))
    found = rows.select("o_orderkey", values.coordinates(F.col("text")).alias("c"))
    return found.select(
        "o_orderkey", F.round("c.latitude", 6).alias("latitude"), F.round("c.longitude", 6).alias("longitude")
    )


def nested_export(spark, folder):
    """Customers with their orders as nested documents, defaults filled in."""
    orders = load(spark, folder, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("status"), F.nullif("o_orderpriority", F.lit("5-LOW")).alias("stages"),
    )
    children = export.with_defaults(orders, words=["status"], numbers=["stages"])
    parents = load(spark, folder, "customer").select("c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"))
    documents = export.nested_documents(
        export.with_defaults(parents, words=["segment"], numbers=[]),
        children, "c_custkey", ["o_orderkey"], ["status", "stages"], "treatments",
    )
    return documents.select("c_custkey", "segment", F.to_json("treatments").alias("treatments"))


def export_documents(spark, folder):
    """Whole documents as JSON text; extracted once, stored, then split into parents and children."""
    path = scratch_dir(spark, "extracted")
    fields.extract_documents(_documents(spark, folder)).drop("text").write.parquet(path)
    extracted = spark.read.parquet(path)
    wells = extracted.select("c_custkey", "file_number", "well_name", "latitude")
    treatments = fields.clean_treatments(extracted.where(F.col("formation").isNotNull()))
    wells = export.with_defaults(wells, ["file_number", "well_name"], []).withColumn(
        "latitude", F.coalesce(F.round("latitude", 6), F.lit(0.0))
    )
    nested = export.nested_documents(
        wells, treatments, "c_custkey", ["c_custkey"], ["formation", "top_ft"], "stimulation_data"
    )
    return export.json_text(nested)


_KIND = """
docs AS (SELECT *, c_nationkey < 7 AS a, c_nationkey BETWEEN 7 AND 11 AS b, c_nationkey BETWEEN 12 AND 18 AS c, c_nationkey > 18 AS d,
  lpad(CAST(c_custkey AS VARCHAR), 5, '0') AS five, 10 + c_nationkey AS m, c_custkey % 60 + 0.25::DOUBLE AS s FROM customer),
wells AS (SELECT c_custkey,
  CASE WHEN c_mktsegment <> 'BUILDING' THEN CAST(c_custkey AS VARCHAR) WHEN a THEN CAST(c_custkey + 500000 AS VARCHAR) END AS file_number,
  CASE WHEN a THEN '33-053-' || five WHEN b THEN '33-105-' || five END AS api_number,
  CASE WHEN a THEN 'STATE ' || c_custkey || '-1H' WHEN c THEN 'BIG HORN ' || c_custkey || 'H' WHEN d THEN 'FOX ' || c_custkey || '-2H' END AS well_name,
  CASE WHEN a THEN 'Oasis Petroleum ' || c_nationkey WHEN c THEN 'Continental Resources Inc' WHEN d THEN 'HESS BAKKEN COMPANY' END AS operator,
  CASE WHEN a THEN 'Dunn' WHEN c THEN 'Williams' END AS county,
  CASE WHEN a THEN 'Sand Creek' WHEN c THEN 'BAKER CREEK' WHEN d THEN 'LITTLE KNIFE' END AS field_name,
  CASE WHEN a THEN CAST(c_nationkey + 1 AS VARCHAR) WHEN c OR d THEN CAST(c_nationkey AS VARCHAR) END AS section,
  CASE WHEN a THEN '150N' WHEN c THEN '151' WHEN d THEN '150' END AS township,
  CASE WHEN a THEN '98W' WHEN c THEN '99' WHEN d THEN '98' END AS range_val,
  CASE WHEN a OR b THEN round(48 + m / 60::DOUBLE + s / 3600::DOUBLE, 6)
       WHEN c THEN CAST('47.' || (100000 + c_custkey) AS DOUBLE) END AS latitude,
  CASE WHEN a THEN -round(103 + m / 60::DOUBLE + 15.5 / 3600::DOUBLE, 6)
       WHEN b THEN -round(102 + m / 60::DOUBLE + 20 / 3600::DOUBLE, 6) WHEN c THEN -102.654321::DOUBLE END AS longitude
  FROM docs),
stims AS (SELECT c_custkey, 'Middle Bakken' AS formation, 'Sand Frac' AS treatment_type, CAST(c_nationkey AS VARCHAR) AS stimulation_stages,
  CAST(120000 + c_custkey AS VARCHAR) AS volume, 'Barrels' AS volume_units, '45000' || c_nationkey AS lbs_proppant,
  '91' || c_nationkey AS max_treatment_pressure, '70.5' AS max_treatment_rate, CAST(10000 + c_nationkey AS VARCHAR) AS top_ft,
  CAST(20000 + c_nationkey AS VARCHAR) AS bottom_ft FROM docs WHERE c)"""

QUERIES = {
    "well_extract": Query(well_extract, f"WITH {_KIND} SELECT * FROM wells"),
    "stim_extract": Query(stim_extract, f"WITH {_KIND} SELECT * FROM stims"),
    "extraction_counts": Query(
        extraction_counts,
        f"""WITH {_KIND}, sized AS (
  SELECT c_custkey, length(CASE WHEN a THEN {_REPORT.format(minute='m', second='s')}
    WHEN b THEN {_SURVEY.format(minute='m', second='s')} WHEN c THEN {_FORM} ELSE {_APPROVAL} END) AS n FROM docs)
SELECT count(*) FILTER (file_number IS NOT NULL) AS succeeded, count(*) FILTER (file_number IS NULL) AS failed,
       CAST(count(stims.c_custkey) FILTER (file_number IS NOT NULL) AS BIGINT) AS treatment_records,
       CAST(sum(n) FILTER (file_number IS NOT NULL) AS BIGINT) AS text_length
FROM wells JOIN sized USING (c_custkey) LEFT JOIN stims USING (c_custkey)""",
    ),
    "cleaned_wells": Query(
        cleaned_wells,
        f"""WITH {_KIND} SELECT c_custkey, 'Active ' || c_custkey % 3 AS well_status, 'N/A' AS well_type,
  'City ' || c_custkey AS closest_city, 'N/A' AS oil_produced, c_custkey || ' MCF' AS gas_produced, coalesce(api_number, 'N/A') AS api_number,
  coalesce(well_name, 'N/A') AS well_name, coalesce(operator, 'N/A') AS operator, coalesce(county, 'N/A') AS county,
  coalesce(field_name, 'N/A') AS field_name, coalesce(section, 'N/A') AS section, coalesce(township, 'N/A') AS township,
  coalesce(range_val, 'N/A') AS range_val, coalesce(latitude, 0) AS latitude, coalesce(longitude, 0) AS longitude FROM wells""",
    ),
    "cleaned_treatments": Query(cleaned_treatments, f"WITH {_KIND} SELECT * FROM stims"),
    "coordinates": Query(
        coordinates,
        """WITH t AS (SELECT o_orderkey, o_orderstatus AS st, month(o_orderdate) AS m, day(o_orderdate) AS d FROM orders)
SELECT o_orderkey, CASE st WHEN 'F' THEN round(47 + m / 60::DOUBLE + (d + 0.5) / 3600::DOUBLE, 6)
    WHEN 'O' THEN round(46 + m / 60::DOUBLE + (d + 0.5) / 3600::DOUBLE, 6) ELSE CAST('48.' || (1000 + d) AS DOUBLE) END AS latitude,
  -CASE st WHEN 'F' THEN round(101 + d / 60::DOUBLE + m / 3600::DOUBLE, 6)
    WHEN 'O' THEN round(105 + d / 60::DOUBLE + m / 3600::DOUBLE, 6) ELSE CAST('104.' || (1000 + m) AS DOUBLE) END AS longitude
FROM t""",
    ),
    "nested_export": Query(
        nested_export,
        """SELECT c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), 'N/A') AS segment,
  coalesce('[' || string_agg('{"status":"' || CASE o_orderstatus WHEN 'P' THEN 'N/A' ELSE o_orderstatus END || '","stages":"' ||
    CASE o_orderpriority WHEN '5-LOW' THEN '0' ELSE o_orderpriority END || '"}', ',' ORDER BY o_orderkey) || ']', '[]') AS treatments
FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL""",
    ),
    "export_documents": Query(
        export_documents,
        f"""WITH {_KIND} SELECT '{{"c_custkey":' || c_custkey || ',"file_number":"' || coalesce(file_number, 'N/A') || '","well_name":"' ||
  coalesce(well_name, 'N/A') || '","latitude":' || CAST(coalesce(latitude, 0) AS VARCHAR) || ',"stimulation_data":[' ||
  coalesce('{{"formation":"' || formation || '","top_ft":"' || top_ft || '"}}', '') || ']}}' AS document
FROM wells LEFT JOIN stims USING (c_custkey)""",
    ),
}
