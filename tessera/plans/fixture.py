"""Records for the named queries: businesses made of customer, part and supplier, one SQL text that Spark and DuckDB run alike.

S1 has a record a customer. S2 has a noisy copy of those with a balance, S3 of most of the others, two of some, and a record a
supplier that matches nobody. Names and addresses vary in case, accents, legal forms, word order, script, abbreviations and gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FIRST = "Anand Sharma Patel Mehta Gupta Kumar Verma Nair Smith Taylor Vaughn Marshall Prospect Tailwind Dieppe Crème Azaé Lefèvre Bois Blanc Schmidt Müller Keller Hartmann Rivera Ortega Quill Harbor Summit Cedar"
HINDI = "आनंद शर्मा पटेल मेहता गुप्ता कुमार वर्मा नायर"
SYLLABLES = ("Ba Ke Lo Mi Nu Ra Se Ti Vo Za Fa Go Hi", "rel mon tik dar pin sol vak nem lur gas bot fin cor das wen zul kap", "a o i en ar is us el on ia um")
SECOND = "Foods Traders Marketing Transports Textiles Motors Brothers Services Systems Hardware Industries"
#: By country: cities, their states, and the states' short names.
PLACES = {
    "US": ("Phoenix Dallas Reno Portland Columbus Tucson", "Arizona Texas Nevada Oregon Ohio Arizona", "AZ TX NV OR OH AZ"),
    "India": ("Hyderabad Surat Mysuru Pune Chennai Nagpur", "Telangana Gujarat Karnataka Maharashtra Odisha Maharashtra", "TG GJ KA MH OD MH"),
    "France": ("Rennes Rouen Toulouse Strasbourg Ajaccio Brest", "Bretagne Normandie Occitanie Alsace Corse Bretagne", "BRE NOR OCC ALS COR BRE"),
    "Germany": ("Berlin Hamburg Essen Kiel Mainz Bonn", "Berlin Hamburg Nordrhein Schleswig Pfalz Nordrhein", "BE HH NW SH RP NW"),
}
STATES_HINDI = "तेलंगाना गुजरात कर्नाटक महाराष्ट्र ओडिशा महाराष्ट्र"
#: (kind, country, variant, canonical, cnt), as mining would give them.
ALIASES = [
    ("state", "US", "az", "arizona", 2634), ("state", "US", "tx", "texas", 410), ("state", "US", "nv", "nevada", 17), ("state", "US", "or", "oregon", 25), ("state", "US", "oh", "ohio", 3),
    ("state", "India", "tg", "telangana", 88), ("state", "India", "gj", "gujarat", 8938), ("state", "India", "ka", "karnataka", 40), ("state", "India", "mh", "maharashtra", 12), ("state", "India", "od", "odisha", 30),
    ("state", "India", "तेलंगाना", "telangana", 61), ("state", "India", "गुजरात", "gujarat", 70), ("state", "India", "कर्नाटक", "karnataka", 9), ("state", "India", "महाराष्ट्र", "maharashtra", 33), ("state", "India", "ओडिशा", "odisha", 8),
    ("state", "_generic", "nw", "nordrhein", 5), ("state", "_generic", "hh", "hamburg", 50), ("state", "_generic", "bre", "bretagne", 21),
    ("city", "US", "pho", "phoenix", 100), ("city", "US", "dal", "dallas", 12), ("city", "US", "ren", "reno", 19), ("city", "US", "tu", "tucson", 300),
    ("city", "India", "hyd", "hyderabad", 31), ("city", "India", "sur", "surat", 20), ("city", "India", "pun", "pune", 7), ("city", "_generic", "ber", "berlin", 44),
]


def _pick(words: str, n: str, size: int | None = None) -> str:
    return f"split_part('{words}', ' ', CAST({n} % {size or len(words.split())} + 1 AS INT))"


def _div(n: int) -> str:
    return f"CAST(floor(k / {n}) AS INT)"


def _by_country(pick) -> str:
    return "CASE country " + " ".join(f"WHEN '{c}' THEN {pick(c)}" for c in list(PLACES)[:-1]) + f" ELSE {pick('Germany')} END"


_LEGAL = "CASE country WHEN 'India' THEN 'Private Limited' WHEN 'France' THEN 'SARL' WHEN 'Germany' THEN 'GmbH' ELSE split_part('Inc Corporation Company', ' ', CAST(k % 3 + 1 AS INT)) END"
_LEGAL_SHORT = "CASE country WHEN 'India' THEN 'Pvt. Ltd.' WHEN 'France' THEN 'Sarl' WHEN 'Germany' THEN 'GmbH' ELSE split_part('Incorporated Corp. Co', ' ', CAST(k % 3 + 1 AS INT)) END"
_CODE = "CASE WHEN k % 3 <> 0 THEN '' WHEN country = 'India' THEN concat(CAST(500000 + k % 1000 AS STRING), ', ') WHEN country = 'Germany' THEN '' ELSE concat(CAST(35000 + k % 1000 AS STRING), ', ') END"
_BASE = f"""cust AS (SELECT CAST(c.c_custkey AS BIGINT) AS k, CASE c.c_nationkey % 5 WHEN 0 THEN 'US' WHEN 1 THEN 'India' WHEN 2 THEN 'France' WHEN 3 THEN 'US' ELSE 'Germany' END AS country,
  c.c_acctbal AS bal, c.c_mktsegment AS seg, p.p_name FROM {{customer}} c JOIN {{part}} p ON p.p_partkey = c.c_custkey),
word AS (SELECT *, CASE WHEN country = 'India' THEN {_pick(FIRST, 'k', 8)} ELSE {_pick(FIRST, 'k')} END AS w1,
  concat({_pick(SYLLABLES[0], 'k')}, {_pick(SYLLABLES[1], _div(13))}, {_pick(SYLLABLES[2], _div(221))}) AS w2, {_pick(SECOND, _div(7))} AS w3,
  {_LEGAL} AS legal, {_LEGAL_SHORT} AS short, {_CODE} AS code,
  concat(CAST({_div(3)} % 400 + 1 AS STRING), ' ') AS num, split_part(p_name, ' ', 2) AS street, {_by_country(lambda c: _pick(PLACES[c][0], 'k'))} AS city,
  {_by_country(lambda c: _pick(PLACES[c][1], 'k'))} AS state, {_by_country(lambda c: _pick(PLACES[c][2], 'k'))} AS st, {_pick(STATES_HINDI, 'k')} AS hindi_state, {_pick(HINDI, 'k', 8)} AS hindi FROM cust),
full_form AS (SELECT *, concat(w1, ' ', w2, ' ', w3, ' ', legal) AS whole, CASE WHEN country = 'France' THEN concat(num, 'Rue ', street) ELSE concat(num, street, ' Road') END AS road,
  CASE WHEN country = 'France' THEN concat(num, 'R. ', street) WHEN k % 2 = 0 THEN concat('00', num, street, ' Rd') ELSE concat('No ', num, street, ' RD.') END AS rd,
  CASE k % 3 WHEN 0 THEN state WHEN 1 THEN st ELSE CASE WHEN country = 'India' THEN hindi_state ELSE st END END AS some_state,
  CASE WHEN k % 4 = 1 THEN upper(substr(city, 1, 3)) ELSE city END AS some_city FROM word)"""
_S2_NAME = """CASE k % 10 WHEN 0 THEN whole WHEN 1 THEN upper(whole) WHEN 2 THEN concat(w1, ' ', w2, ' ', w3, ' ', short) WHEN 3 THEN concat(w2, ' ', w1, ' ', legal, ' ', w3)
  WHEN 4 THEN concat(lower(w2), lower(w3), '.com') WHEN 5 THEN concat(w1, ' ', replace(w2, 'a', 'e'), ' ', w3) WHEN 6 THEN translate(whole, 'aeiou', 'áéíóú')
  WHEN 7 THEN CASE WHEN country = 'India' THEN concat(hindi, ' ', w2, ' प्राइवेट लिमिटेड') ELSE concat('The ', whole) END WHEN 8 THEN concat(w1, ' ', w2) ELSE concat(w1, '-', w2, ' & ', w3, ', ', short) END"""
_S2_ADDRESS = """CASE k % 8 WHEN 0 THEN '' WHEN 1 THEN concat(some_state, ', ', city, ', ', rd) WHEN 2 THEN concat(rd, ', NULL, ', code, city, ', ', some_state)
  WHEN 3 THEN concat(num, street, ' St, near ', w3, ', ', code, some_city, ', ', some_state) ELSE concat(rd, ', ', code, some_city, ', ', some_state) END"""
_S3_NAME = f"""CASE {_div(10)} % 6 WHEN 0 THEN concat(w1, ' ', w2, ' ', w3) WHEN 1 THEN concat(whole, ' - ', city) WHEN 2 THEN lower(whole) WHEN 3 THEN concat(w1, w2, ' ', w3, ' ', short)
  WHEN 4 THEN concat(w2, ' ', w3, ' plc') ELSE concat(w1, ' ', reverse(w2), ' ', w3, ' ', legal) END"""
_S3_ADDRESS = "CASE k % 5 WHEN 0 THEN concat(road, ', ', city, ', ', state) WHEN 1 THEN concat(city, ', ', some_state) WHEN 2 THEN concat('Shop 4, ', rd, ', n/a, ', code, city, ', ', some_state) ELSE concat(rd, ', ', some_city, ', ', some_state) END"
_RECORDS = f"""rec AS (SELECT concat('S1-', CAST(k AS STRING)) AS entity_id, k + 1 AS pos, 'S1' AS source, whole AS business_name, concat(road, ', ', code, city, ', ', state) AS business_address, country FROM full_form
UNION ALL SELECT concat('S2-', CAST(k AS STRING)), k + 1, 'S2', {_S2_NAME}, {_S2_ADDRESS}, CASE WHEN k % 97 = 3 THEN 'Germany' WHEN k % 89 = 5 THEN concat(lower(country), ' ') WHEN k % 83 = 7 THEN '' ELSE country END FROM full_form WHERE bal >= 0
UNION ALL SELECT concat('S3-', CAST(k AS STRING)), k + 1, 'S3', {_S3_NAME}, {_S3_ADDRESS}, country FROM full_form WHERE seg <> 'MACHINERY' AND bal < 7000
UNION ALL SELECT concat('S3-', CAST(10000000 + k AS STRING)), 10000001 + k, 'S3', upper(concat(w1, ' ', w2, ' ', short)), concat(rd, ', ', city), country FROM full_form WHERE seg = 'BUILDING' AND bal < 7000
UNION ALL SELECT concat('S3-', CAST(20000000 + s_suppkey AS STRING)), 20000001 + s_suppkey, 'S3', replace(s_name, '#', ' '), concat(CAST(s_nationkey AS STRING), ' Harbor Blvd, NULL'), 'US' FROM {{supplier}})"""
_TRUTH = """truth AS (SELECT concat('S1-', CAST(k AS STRING)) AS s1_id, concat('S2-', CAST(k AS STRING)) AS target_id, 'S2' AS target_source FROM cust WHERE bal >= 0
UNION ALL SELECT concat('S1-', CAST(k AS STRING)), concat('S3-', CAST(k AS STRING)), 'S3' FROM cust WHERE seg <> 'MACHINERY' AND bal < 7000
UNION ALL SELECT concat('S1-', CAST(k AS STRING)), concat('S3-', CAST(10000000 + k AS STRING)), 'S3' FROM cust WHERE seg = 'BUILDING' AND bal < 7000)"""
#: For DuckDB, as the beginning of a WITH.
SQL = ", ".join((_BASE, _RECORDS, _TRUTH)).replace("{customer}", "customer").replace("{part}", "part").replace("{supplier}", "supplier")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _run(spark: SparkSession, sf: str, what: str, of: str) -> DataFrame:
    tables = {name: table(spark, sf, name) for name in ("customer", "part", "supplier") if "{" + name + "}" in _BASE + of}
    return spark.sql(f"WITH {_BASE}, {of} SELECT * FROM {what}", **tables)


def records(spark: SparkSession, sf: str) -> DataFrame:
    """(entity_id, pos, source, business_name, business_address, country)."""
    return _run(spark, sf, "rec", _RECORDS)


def truth(spark: SparkSession, sf: str) -> DataFrame:
    """(s1_id, target_id, target_source)."""
    return _run(spark, sf, "truth", _TRUTH)


def aliases(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ALIASES, "kind string, country string, variant string, canonical string, cnt bigint")
