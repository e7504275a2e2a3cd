"""The registered queries as plain SQL over the same tables."""

from __future__ import annotations

VIEWS = """
WITH RECURSIVE base AS (
  SELECT c_custkey AS id, concat(lower(replace(c_name,'#','.')),'@',lower(c_mktsegment),'.example') AS mail,
    concat(lower(c_mktsegment),'.example') AS domain FROM customer),
id AS (
  SELECT o_orderkey AS id, o_custkey AS mail_id,
    CASE o_orderstatus WHEN 'P' THEN '1.0' WHEN 'F' THEN '2.0' END AS civilite,
    nullif(o_orderpriority,'4-NOT SPECIFIED') AS prenom, c_mktsegment AS nom,
    concat(lpad(CAST(c_nationkey AS VARCHAR),2,'0'),'000') AS cp, n_name AS ville,
    CAST(o_orderdate AS DATE) AS birth
  FROM orders JOIN customer ON c_custkey=o_custkey JOIN nation ON n_nationkey=c_nationkey),
lead AS (
  SELECT user_id AS mail_id, concat('10.0.0.',CAST(event_id % 250 AS VARCHAR)) AS ip, props AS provenance, ts AS date
  FROM events WHERE event_type='signup'),
md5_table AS (SELECT id AS mail_id, md5(mail) AS md5 FROM base),
sms AS (
  SELECT c_custkey AS mail_id, CAST(c_nationkey AS BIGINT) AS port FROM customer WHERE c_acctbal > 5000
  UNION ALL SELECT s_suppkey+1000000, CAST(s_nationkey AS BIGINT) FROM supplier),
fichier_list AS (SELECT p_partkey AS id, p_brand AS fichier_num FROM part),
fichier_match AS (
  SELECT DISTINCT o_custkey AS mail_id, l_partkey AS fichier_id FROM lineitem JOIN orders ON o_orderkey=l_orderkey),
regie_list AS (SELECT s_suppkey AS id, s_name AS abreviation FROM supplier),
regie_match AS (
  SELECT DISTINCT o_custkey AS mail_id, l_suppkey AS regie_id
  FROM lineitem JOIN orders ON o_orderkey=l_orderkey WHERE l_quantity > 45),
regie_actif AS (
  SELECT o_custkey AS mail_id, l_suppkey AS regie_id, max(l_shipdate) AS date
  FROM lineitem JOIN orders ON o_orderkey=l_orderkey WHERE l_returnflag='N' GROUP BY o_custkey, l_suppkey),
partner_match AS (SELECT DISTINCT o_custkey AS mail_id, o_orderpriority AS partner_id FROM orders),
optin_list AS (SELECT n_nationkey AS id, n_name AS abreviation FROM nation),
optin_match AS (
  SELECT DISTINCT o_custkey AS mail_id, s_nationkey AS optin_id
  FROM lineitem JOIN orders ON o_orderkey=l_orderkey JOIN supplier ON s_suppkey=l_suppkey WHERE l_quantity > 40),
optin_desabo AS (
  SELECT DISTINCT user_id AS mail_id, CAST(event_id % 25 AS INT) AS optin_id,
    CASE WHEN value > 40 THEN 'spam' WHEN value > 20 THEN 'npai' ELSE 'other' END AS comment
  FROM events WHERE event_type='error'),
base_plainte AS (SELECT DISTINCT user_id AS mail_id FROM events WHERE event_type='error' AND value > 60),
base_npai AS (SELECT DISTINCT o_custkey AS mail_id FROM orders WHERE o_totalprice > 490000),
base_ouvreur AS (SELECT DISTINCT user_id AS mail_id FROM events WHERE event_type='view' AND value > 30),
campagne_ouvreur AS (
  SELECT DISTINCT user_id AS mail_id, concat('10.0.1.',CAST(event_id % 250 AS VARCHAR)) AS ip
  FROM events WHERE event_type='click'),
log_criteo AS (SELECT DISTINCT user_id AS mail_id FROM events WHERE event_type='purchase'),
base_mxm AS (SELECT c_custkey AS mail_id FROM customer WHERE c_custkey % 11 = 3),
base_not_b2c AS (SELECT c_custkey AS mail_id FROM customer WHERE c_nationkey = 5),
mot_list AS (
  SELECT r_regionkey AS id, concat(CAST(r_regionkey AS VARCHAR),CAST(r_regionkey AS VARCHAR),'@') AS mot,
    r_name AS secteur, r_regionkey < 3 AS exclusion FROM region),
mot_match AS (
  SELECT b.id AS mail_id, m.id AS mot_list_id FROM base b JOIN mot_list m ON contains(b.mail, m.mot) WHERE m.exclusion),
appetence_list AS (SELECT p_partkey AS id, p_type AS interet FROM part),
appetence_match AS (
  SELECT o_custkey AS mail_id, l_partkey AS appetence_id, CAST(sum(l_quantity) AS DOUBLE) AS score
  FROM lineitem JOIN orders ON o_orderkey=l_orderkey GROUP BY o_custkey, l_partkey),
dirty_id AS (
  SELECT o_orderkey AS id,
    CASE o_orderkey % 6 WHEN 0 THEN '1.0' WHEN 1 THEN '2.0' WHEN 2 THEN '3.0' WHEN 3 THEN '4.0' WHEN 4 THEN 'nan' END AS civilite,
    concat(lpad(CAST(o_custkey % 98 AS VARCHAR),5,'0'),CASE WHEN o_orderkey % 2 = 0 THEN '.0' ELSE '' END) AS cp,
    CAST(o_orderdate AS DATE) AS birth FROM orders),
id_unik AS (
  SELECT mail_id, """ + ", ".join(
    f"coalesce(string_agg(DISTINCT CAST({c} AS VARCHAR), ',' ORDER BY CAST({c} AS VARCHAR)),'') AS {c}"
    for c in ["civilite", "prenom", "nom", "cp", "ville", "birth"]
) + """ FROM id GROUP BY mail_id),
outside AS (
  SELECT b.mail, l.ip FROM base b JOIN lead l ON l.mail_id = b.id
  UNION ALL SELECT b.mail, NULL FROM base b JOIN sms s ON s.mail_id = b.id
  UNION ALL SELECT concat(lower(replace(abreviation,'#','.')),'@supplier.example'), NULL FROM regie_list),
incoming AS (SELECT mail, md5(mail) AS md5 FROM outside),
extract AS (
  SELECT b.mail, i.prenom, i.nom, i.civilite, i.birth, i.cp, concat(' ', l.provenance, ' ') AS raw, l.provenance
  FROM base b JOIN id i ON i.mail_id = b.id LEFT JOIN lead l ON l.mail_id = b.id),
contact_id AS (SELECT b.id, b.mail, i.civilite, i.prenom, i.birth FROM base b LEFT JOIN id i ON i.mail_id = b.id)
"""

ID = "i.civilite, i.prenom, i.nom, i.cp, i.ville, i.birth"

# Conditions on a contact; {k} is the expression of its key.
_PARTNER = "EXISTS (SELECT 1 FROM partner_match x WHERE x.mail_id = {k} AND x.partner_id IN ({v}))"
_FILE = ("EXISTS (SELECT 1 FROM fichier_match x JOIN fichier_list y ON y.id = x.fichier_id "
         "WHERE x.mail_id = {k} AND y.fichier_num IN ({v}))")
_BROKER = ("EXISTS (SELECT 1 FROM regie_match x JOIN regie_list y ON y.id = x.regie_id "
           "WHERE x.mail_id = {k} AND y.abreviation IN ({v}))")
_BROKER_ID = "EXISTS (SELECT 1 FROM regie_match x WHERE x.mail_id = {k} AND x.regie_id IN ({v}))"
_OPTIN = ("EXISTS (SELECT 1 FROM optin_match x JOIN optin_list y ON y.id = x.optin_id "
          "WHERE x.mail_id = {k} AND y.abreviation IN ({v}))")
_DESABO = ("EXISTS (SELECT 1 FROM optin_desabo x JOIN optin_list y ON y.id = x.optin_id "
           "WHERE x.mail_id = {k} AND y.abreviation IN ({v}))")
_NAMED = {
    "plainte": "EXISTS (SELECT 1 FROM base_plainte x WHERE x.mail_id = {k})",
    "mot": "EXISTS (SELECT 1 FROM mot_match x WHERE x.mail_id = {k})",
    "npai": "EXISTS (SELECT 1 FROM base_npai x WHERE x.mail_id = {k})",
    "spam": "EXISTS (SELECT 1 FROM optin_desabo x WHERE x.mail_id = {k} AND x.comment IN ('spam','npai'))",
    "ouvreur": "EXISTS (SELECT 1 FROM base_ouvreur x WHERE x.mail_id = {k})",
    "ouvreur_campagne": "EXISTS (SELECT 1 FROM campagne_ouvreur x WHERE x.mail_id = {k})",
    "criteo": "EXISTS (SELECT 1 FROM log_criteo x WHERE x.mail_id = {k})",
    "mxm": "EXISTS (SELECT 1 FROM base_mxm x WHERE x.mail_id = {k})",
    "not_b2c": "EXISTS (SELECT 1 FROM base_not_b2c x WHERE x.mail_id = {k})",
    "actif": "EXISTS (SELECT 1 FROM regie_actif x WHERE x.mail_id = {k})",
}


# Leads without date or ip, and identities without any name.
_PATCHY_LEAD = """(SELECT mail_id, CASE WHEN mail_id % 4 <> 1 THEN ip END AS ip, provenance, CASE WHEN mail_id % 3 <> 0 THEN date END AS date FROM lead) l"""
_PATCHY_ID = """(SELECT id, mail_id, CASE WHEN id % 5 <> 0 THEN civilite END AS civilite, CASE WHEN id % 5 <> 0 THEN prenom END AS prenom, CASE WHEN id % 5 <> 0 THEN nom END AS nom, cp, ville, birth FROM id) i"""


def _in(template: str, *values, k: str = "b.id") -> str:
    shown = ", ".join(str(v) if isinstance(v, int) else f"'{v}'" for v in values)
    return template.format(k=k, v=shown)


def _named(name: str, k: str = "b.id") -> str:
    return _NAMED[name].format(k=k)


def _without(*names: str, k: str = "b.id") -> str:
    return " AND ".join("NOT " + _named(n, k) for n in names)


def _sql(text: str) -> str:
    return VIEWS + text


FILES = ("Brand#1", "Brand#17")
BROKER = "Supplier#000000003"
BROKERS = ("Supplier#000000003", "Supplier#000000007")
FILE_OUT = ("plainte", "mot", "npai")
PARTNER_OUT = ("plainte", "mot", "spam")

_SEGMENT = " AND ".join([
    _in(_PARTNER, "1-URGENT", "2-HIGH"), _in(_FILE, *FILES), "NOT " + _in(_BROKER, BROKER),
    _without("plainte", "mot", "spam", "npai"),
])

_BASE_ID = "FROM base b LEFT JOIN id i ON i.mail_id = b.id"
_PLACED = "coalesce(i.id, -b.id - 1)"


def _latest(where: str) -> str:
    """One row per identity, contacts without one standing for themselves."""
    return f"""SELECT mail, civilite, prenom, nom, cp, ville, birth FROM (
      SELECT b.mail, {ID}, row_number() OVER (PARTITION BY {_PLACED}
        ORDER BY b.mail, {ID}) AS rn {_BASE_ID} WHERE {where}) WHERE rn = 1"""


_PER_HASH = """SELECT md5, mail, civilite, prenom, nom, cp, ville, birth, provenance, date, ip, ip2 FROM (
  SELECT m.md5, b.mail, i.civilite, i.prenom, i.nom, i.cp, i.ville, i.birth, l.provenance, l.date, l.ip, c.ip AS ip2,
    row_number() OVER (PARTITION BY m.md5 ORDER BY b.mail NULLS LAST, i.civilite NULLS LAST, i.prenom NULLS LAST,
      i.nom NULLS LAST, i.cp NULLS LAST, i.ville NULLS LAST, i.birth NULLS LAST, l.provenance NULLS LAST,
      l.date NULLS LAST, l.ip NULLS LAST, c.ip NULLS LAST) AS rn
  FROM md5_table m LEFT JOIN id i ON i.mail_id = m.mail_id LEFT JOIN base b ON b.id = m.mail_id
  LEFT JOIN lead l ON l.mail_id = m.mail_id LEFT JOIN campagne_ouvreur c ON c.mail_id = m.mail_id
  WHERE {where}) WHERE rn = 1"""

_SMS = f"SELECT b.mail, s.port, {ID} FROM (SELECT * FROM base b WHERE {{where}}) b {{how}} JOIN sms s ON s.mail_id = b.id LEFT JOIN id i ON i.mail_id = b.id"

_CLEAN = """SELECT DISTINCT mail, prenom, nom, CASE WHEN lower(trim(civilite)) NOT IN ('none','nan') THEN regexp_replace(civilite, '^(\\d+)[.,].*$', '\\1') END AS civilite,
  CASE WHEN year(birth) <= 1 THEN NULL WHEN year(birth) <= 1900 OR year(birth) > 2014
    THEN birth + CAST((19 - year(birth) // 100) * 36500 AS INTEGER) ELSE birth END AS birth,
  cp, provenance FROM extract e WHERE mail IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM base b JOIN base_plainte p ON p.mail_id = b.id WHERE b.mail = e.mail)"""

# Fixed value: the form of an address.
_ADDRESS = r"^[a-z0-9!#$%&''*+/=?^_`{|}~.-]+@[a-z0-9](?:[a-z0-9-]*[a-z0-9])?(?:\.[a-z0-9](?:[a-z0-9-]*[a-z0-9])?)+$"

_WORDS = r"SELECT doc_id, unnest(regexp_split_to_array(text, '[ \n\t\r]+')) AS mail FROM documents"

_ATTRIBUTES = " UNION ALL ".join(
    f"SELECT mail_id, {k} AS place, '{c}' AS name, unnest(string_split({c}, ',')) AS value, "
    f"generate_subscripts(string_split({c}, ','), 1) AS n FROM id_unik WHERE {c} <> ''"
    for k, c in enumerate(["civilite", "prenom", "nom", "cp", "ville", "birth"])
)

_NAMES = """
  SELECT concat(CASE p_partkey % 5 WHEN 0 THEN concat(p_partkey, '-2') WHEN 1 THEN concat(p_partkey, 'X')
      WHEN 2 THEN 'EXP-ABC' WHEN 3 THEN concat('OK_', p_partkey) ELSE CAST(p_partkey AS VARCHAR) END,
    '_', replace(p_name, ' ', '-'), '_[mail, civilite,', lower(p_type), ']',
    CASE p_size % 3 WHEN 0 THEN '_[ouvreur]' WHEN 1 THEN '_[regie:ads]' ELSE '' END, '_', p_size, 'k.csv') AS name
  FROM part"""

_NUMBER = "TRY_CAST(replace(replace(string_split(name, '_')[1], '-', '.'), 'X', '.9') AS DOUBLE)"


def _mails_of(*names: str) -> str:
    return " UNION ".join(f"SELECT b.mail FROM base b WHERE {_named(n)}" for n in names)


def oracle_sql() -> dict[str, str]:
    texts = {
        "segment_classic": f"SELECT DISTINCT b.mail, {ID} {_BASE_ID} WHERE {_SEGMENT}",
        "segment_ip": f"""SELECT DISTINCT b.mail, {ID}, c.ip {_BASE_ID}
            LEFT JOIN campagne_ouvreur c ON c.mail_id = b.id WHERE {_SEGMENT}""",
        "segment_provenance": f"""SELECT DISTINCT b.mail, {ID}, l.ip, l.provenance, l.date {_BASE_ID}
            LEFT JOIN lead l ON l.mail_id = b.id WHERE {_SEGMENT}""",
        "segment_identity_latest": _latest(_SEGMENT),
        "segment_packed": f"SELECT DISTINCT b.mail, {ID} FROM base b LEFT JOIN id_unik i ON i.mail_id = b.id WHERE {_SEGMENT}",
        "segment_openers": f"""SELECT DISTINCT b.mail, {ID} {_BASE_ID}
            WHERE {_named('ouvreur_campagne')} AND {_named('criteo')} AND NOT {_in(_FILE, 'Brand#17')}
            AND NOT {_in(_BROKER, *BROKERS)} AND {_without('plainte', 'mot')}""",
        "segment_described_right": f"""SELECT x.mail, x.md5, l.ip, l.provenance FROM lead l LEFT JOIN (
              SELECT b.id, b.mail, m.md5 FROM base b LEFT JOIN md5_table m ON m.mail_id = b.id WHERE {_in(_PARTNER, '3-MEDIUM', '1-URGENT')}) x
            ON x.id = l.mail_id ORDER BY x.mail NULLS LAST, x.md5 NULLS LAST, l.ip NULLS LAST, l.provenance NULLS LAST LIMIT 500""",
        "segment_described": f"""SELECT b.mail, b.id, {ID}, l.ip, l.provenance, l.date {_BASE_ID}
            LEFT JOIN lead l ON l.mail_id = b.id WHERE l.ip IS NOT NULL AND {_in(_FILE, *FILES)}""",
        "common_with_partner": f"""SELECT r.broker, b.mail, {ID} {_BASE_ID}
            CROSS JOIN (SELECT unnest({list(BROKERS)}) AS broker) r
            WHERE {_in(_PARTNER, '3-MEDIUM')} AND {_without(*PARTNER_OUT)}
            AND NOT EXISTS (SELECT 1 FROM regie_match x JOIN regie_list y ON y.id = x.regie_id
                WHERE x.mail_id = b.id AND y.abreviation = r.broker)""",
        "common_with_file": f"""SELECT f.fichier_num, r.broker, b.mail, {ID} {_BASE_ID}
            CROSS JOIN (SELECT unnest({list(BROKERS)}) AS broker) r
            CROSS JOIN (SELECT unnest({list(FILES)}) AS fichier_num) f
            WHERE EXISTS (SELECT 1 FROM fichier_match x JOIN fichier_list y ON y.id = x.fichier_id
                WHERE x.mail_id = b.id AND y.fichier_num = f.fichier_num)
            AND {_without(*PARTNER_OUT)}
            AND NOT EXISTS (SELECT 1 FROM regie_match x JOIN regie_list y ON y.id = x.regie_id
                WHERE x.mail_id = b.id AND y.abreviation = r.broker)""",
        "active_openers": f"""SELECT b.mail, a.date, {ID} {_BASE_ID} JOIN base_ouvreur o ON o.mail_id = b.id
            JOIN regie_actif a ON a.mail_id = b.id
            WHERE b.id IN (SELECT x.mail_id FROM regie_actif x JOIN regie_list y ON y.id = x.regie_id
                WHERE regexp_matches(y.abreviation, '(00003|00007)')) AND {_without('plainte', 'mot')}""",
        "file_clean": f"SELECT b.mail, {ID} {_BASE_ID} WHERE {_in(_FILE, *FILES)} AND {_without(*FILE_OUT, 'ouvreur')}",
        "partner_identities": _latest(
            _in(_PARTNER, "1-URGENT", "2-HIGH") + " AND " + _without("plainte", "mot", "npai", "spam")),
        "optin_minus_unsub": f"""SELECT b.mail, i.civilite, i.prenom, i.nom {_BASE_ID}
            WHERE {_in(_OPTIN, 'NATION_10')} AND NOT {_in(_DESABO, 'NATION_10')}""",
        "broker_optin": f"""SELECT b.mail, {ID} {_BASE_ID} WHERE {_in(_BROKER, BROKER)} AND {_in(_OPTIN, 'NATION_7')}
            AND NOT {_in(_DESABO, 'NATION_7')} AND {_without(*FILE_OUT)}""",
        "optin_difference": f"SELECT b.mail FROM base b WHERE {_in(_OPTIN, 'NATION_10')} AND NOT {_in(_OPTIN, 'NATION_7')}",
        "hash_export": f"""SELECT DISTINCT m.md5 FROM md5_table m WHERE {_in(_FILE, *FILES, k='m.mail_id')}
            AND {_without(*FILE_OUT, 'ouvreur', k='m.mail_id')}""",
        "hash_export_capped": f"""SELECT DISTINCT m.md5 FROM md5_table m WHERE {_in(_FILE, *FILES, k='m.mail_id')}
            AND {_without(*FILE_OUT, 'ouvreur', k='m.mail_id')} ORDER BY m.md5 LIMIT 400""",
        "hashes_of_files": """SELECT DISTINCT m.md5 FROM md5_table m JOIN fichier_match f ON f.mail_id = m.mail_id
            WHERE f.fichier_id IN (7, 8, 10, 13)""",
        "qualified_leads": f"""SELECT b.mail, {ID}, l.ip, l.date, l.provenance {_BASE_ID} LEFT JOIN lead l ON l.mail_id = b.id
            WHERE i.civilite IS NOT NULL AND i.cp IS NOT NULL AND i.birth IS NOT NULL AND {_named('actif')}
            AND NOT {_in(_BROKER_ID, 4)} AND {_without(*FILE_OUT)}""",
        "mail_hash": f"SELECT b.mail, m.md5 FROM base b LEFT JOIN md5_table m ON m.mail_id = b.id WHERE {_in(_BROKER_ID, 4)}",
        "optin_mails": "SELECT b.mail FROM base b WHERE EXISTS (SELECT 1 FROM optin_match x WHERE x.mail_id = b.id AND x.optin_id = 2)",
        "sms_right_join": _SMS.format(where="true", how="RIGHT"),
        "sms_prefiltered": _SMS.format(where=_without(*FILE_OUT), how="RIGHT"),
        "sms_from_file": _SMS.format(where=f"{_in(_FILE, *FILES)} AND {_without(*FILE_OUT)}", how="INNER"),
        "sms_with_partner": _SMS.format(
            where=f"{_in(_PARTNER, '1-URGENT')} AND {_without('plainte')} AND NOT EXISTS (SELECT 1 FROM optin_desabo x WHERE x.mail_id = b.id AND x.comment = 'spam')",
            how="INNER"),
        "partner_openers": f"""SELECT DISTINCT b.mail, {ID}, c.ip FROM base b LEFT JOIN id_unik i ON i.mail_id = b.id
            LEFT JOIN campagne_ouvreur c ON c.mail_id = b.id
            WHERE {_in(_PARTNER, '1-URGENT', '2-HIGH', '3-MEDIUM')} AND NOT {_in(_BROKER, BROKER)} AND {_without(*PARTNER_OUT)}""",
        "one_per_hash": _PER_HASH.format(where="true"),
        "partner_one_per_hash": _PER_HASH.format(
            where=f"{_in(_PARTNER, '1-URGENT')} AND NOT {_in(_BROKER_ID, 8)} AND {_without(*PARTNER_OUT)}"),
        "hashes_with_ip": f"""SELECT md5, coalesce(ip, ip2) AS ip FROM ({_PER_HASH.format(where='true')}) t
            WHERE ip LIKE '%.%' OR ip2 LIKE '%.%'""",
        "one_per_mail": f"""SELECT mail, civilite, prenom, nom, cp, ville, birth FROM (
            SELECT b.mail, {ID}, row_number() OVER (PARTITION BY b.mail ORDER BY {ID}) AS rn {_BASE_ID}
            WHERE {_in(_FILE, *FILES)} AND {_without(*FILE_OUT)}) WHERE rn = 1""",
        "department": f"""SELECT DISTINCT b.mail FROM base b JOIN id i ON i.mail_id = b.id
            WHERE left(i.cp, 2) IN ('01','07','08','11','12','13') AND {_without(*PARTNER_OUT)}""",
        "town_or_department": """SELECT DISTINCT b.mail FROM base b JOIN id i ON i.mail_id = b.id
            WHERE i.ville = 'NATION_3' OR left(i.cp, 2) = '12'""",
        "blacklist": f"""SELECT b.mail FROM base b WHERE {_in(_FILE, *FILES)}
            AND ({_named('plainte')} OR {_named('mot')} OR {_named('spam')})""",
        "known_hashes": """SELECT DISTINCT m.md5 FROM md5_table m
            WHERE EXISTS (SELECT 1 FROM regie_match x WHERE x.mail_id = m.mail_id)
            OR EXISTS (SELECT 1 FROM partner_match x WHERE x.mail_id = m.mail_id)""",
        "profile_exports": """SELECT DISTINCT b.mail, m.md5, i.civilite FROM base b JOIN md5_table m ON m.mail_id = b.id
            LEFT JOIN id i ON i.mail_id = b.id LEFT JOIN lead l ON l.mail_id = b.id
            WHERE i.civilite IS NOT NULL AND l.date IS NOT NULL""",
        "profiles_with_lead_date": f"""SELECT b.mail, {ID}, l.ip, l.provenance, l.date FROM {_PATCHY_LEAD}
            RIGHT JOIN {_PATCHY_ID} ON l.mail_id = i.mail_id RIGHT JOIN base b ON l.mail_id = b.id WHERE l.date IS NOT NULL""",
        "profiles_with_any_name": f"""SELECT b.mail, {ID}, l.ip, l.provenance, l.date FROM base b JOIN {_PATCHY_ID} ON b.id = i.mail_id
            JOIN {_PATCHY_LEAD} ON l.mail_id = i.mail_id
            WHERE i.prenom IS NOT NULL OR i.nom IS NOT NULL OR i.civilite IS NOT NULL""",
        "profiles_limited": f"""SELECT b.mail, {ID}, l.ip, l.provenance, l.date FROM base b JOIN {_PATCHY_ID} ON b.id = i.mail_id
            JOIN {_PATCHY_LEAD} ON l.mail_id = i.mail_id
            WHERE i.prenom IS NOT NULL OR i.nom IS NOT NULL OR i.civilite IS NOT NULL
            ORDER BY b.mail, i.civilite NULLS LAST, i.prenom NULLS LAST, i.nom NULLS LAST, i.cp NULLS LAST, i.ville NULLS LAST,
              i.birth NULLS LAST, l.ip NULLS LAST, l.provenance NULLS LAST, l.date NULLS LAST LIMIT 200""",
        "profiles_with_ip": f"""SELECT b.mail, {ID}, l.ip, l.provenance, l.date FROM base b JOIN {_PATCHY_ID} ON b.id = i.mail_id
            JOIN {_PATCHY_LEAD} ON l.mail_id = i.mail_id WHERE l.ip IS NOT NULL""",
        "profiles_with_hash": f"""SELECT b.mail, m.md5, {ID}, l.ip, l.provenance, l.date FROM base b
            LEFT JOIN md5_table m ON b.id = m.mail_id LEFT JOIN id i ON b.id = i.mail_id
            LEFT JOIN lead l ON l.mail_id = i.mail_id""",
        "mails_and_hashes": "SELECT b.mail, m.md5 FROM base b JOIN md5_table m ON b.id = m.mail_id",
        "file_profiles": f"""SELECT b.mail, {ID}, l.ip, l.provenance, l.date {_BASE_ID} LEFT JOIN lead l ON l.mail_id = b.id
            JOIN fichier_match f ON f.mail_id = b.id WHERE f.fichier_id = 7""",
        "file_interests": """SELECT b.mail, a.interet, s.score FROM appetence_match s JOIN base b ON b.id = s.mail_id
            JOIN appetence_list a ON a.id = s.appetence_id JOIN fichier_match f ON f.mail_id = s.mail_id
            WHERE f.fichier_id = 7""",
        "file_pattern": """SELECT b.mail, f.fichier_id FROM base b JOIN fichier_match f ON f.mail_id = b.id
            JOIN fichier_list y ON y.id = f.fichier_id WHERE regexp_full_match(y.fichier_num, 'Brand#1|Brand#2.')""",
        "qualified_by_file_pattern": f"""SELECT b.mail, {ID}, l.ip, l.provenance, l.date FROM base b JOIN id i ON i.mail_id = b.id
            JOIN lead l ON l.mail_id = b.id WHERE i.birth IS NOT NULL AND i.civilite IS NOT NULL
            AND b.id IN (SELECT f.mail_id FROM fichier_match f JOIN fichier_list y ON y.id = f.fichier_id
                WHERE regexp_full_match(y.fichier_num, 'Brand#1|Brand#2.'))""",
        "non_webmail": f"""SELECT fichier_num, mail FROM (
            SELECT fichier_num, mail, row_number() OVER (PARTITION BY fichier_num ORDER BY md5(concat('11:', mail)), mail) AS rn
            FROM (SELECT DISTINCT y.fichier_num, b.mail, b.id FROM base b JOIN fichier_match f ON f.mail_id = b.id
                JOIN fichier_list y ON y.id = f.fichier_id
                WHERE split_part(y.fichier_num, '-', 1) IN ('Brand#8','Brand#12','Brand#13')
                AND b.domain NOT IN ('household.example','machinery.example') AND {_without('plainte', 'npai', 'mot')})
            ) WHERE rn <= 200""",
        "non_webmail_b2c": f"""SELECT fichier_num, mail FROM (
            SELECT fichier_num, mail, row_number() OVER (PARTITION BY fichier_num ORDER BY md5(concat('11:', mail)), mail) AS rn
            FROM (SELECT DISTINCT y.fichier_num, b.mail, b.id FROM base b JOIN fichier_match f ON f.mail_id = b.id
                JOIN fichier_list y ON y.id = f.fichier_id
                WHERE split_part(y.fichier_num, '-', 1) IN ('Brand#8','Brand#16')
                AND b.domain NOT IN ('building.example') AND {_without('plainte', 'npai', 'mxm', 'not_b2c')})
            ) WHERE rn <= 150""",
        "suppress_union": f"SELECT o.mail, o.ip FROM outside o WHERE o.mail NOT IN ({_mails_of('plainte', 'npai', 'mot', 'spam')})",
        "flag_filter": f"SELECT b.mail FROM base b WHERE {_named('ouvreur')} AND {_without('plainte', 'npai', 'mot')}",
        "clean_by_lists": f"""SELECT mail, birth, regexp_replace(civilite, '^(\\d+)[.,].*$', '\\1') AS civilite, prenom, nom,
            regexp_replace(cp, '^(\\d+)[.,].*$', '\\1') AS cp, ville FROM (
              SELECT b.mail, {ID}, row_number() OVER (PARTITION BY b.mail ORDER BY i.birth NULLS LAST, i.civilite NULLS LAST,
                i.prenom NULLS LAST, i.nom NULLS LAST, i.cp NULLS LAST, i.ville NULLS LAST) AS rn
              FROM base b JOIN id i ON i.mail_id = b.id) WHERE rn = 1
            AND mail NOT IN ({_mails_of('spam', 'npai', 'plainte')})""",
        "flagged_mails": f"SELECT b.mail FROM base b WHERE {_without('mot', 'plainte')}",
        "full_clean_up": _CLEAN,
        "export_mail_unique": f"""SELECT mail, prenom, nom, civilite, birth, cp, provenance FROM (
            SELECT *, row_number() OVER (PARTITION BY mail ORDER BY prenom NULLS LAST, nom NULLS LAST, civilite NULLS LAST,
              birth NULLS LAST, cp NULLS LAST, provenance NULLS LAST) AS rn FROM ({_CLEAN})) WHERE rn = 1""",
        "export_mail_only": "SELECT DISTINCT mail FROM outside",
        "openers_and_others": f"""SELECT b.mail {_BASE_ID} WHERE {_named('ouvreur')}
            UNION ALL SELECT b.mail {_BASE_ID} WHERE NOT {_named('ouvreur')}""",
        "identity_unique": "SELECT * FROM id_unik",
        "identity_clean": "SELECT min(id) AS id, mail_id, civilite, prenom, nom FROM id GROUP BY mail_id, civilite, prenom, nom",
        "identity_unpack": f"SELECT mail_id, concat(name, '_', n) AS attribute, value FROM ({_ATTRIBUTES})",
        "key_value": f"""SELECT m.md5, CASE WHEN u.mail_id IS NULL THEN '{{}}' ELSE t.id END AS id FROM md5_table m
            LEFT JOIN id_unik u ON u.mail_id = m.mail_id
            LEFT JOIN (SELECT mail_id, concat('{{', string_agg(concat('"', name, '_', n, '":"', value, '"'), ',' ORDER BY place, n), '}}') AS id
                FROM ({_ATTRIBUTES}) GROUP BY mail_id) t ON t.mail_id = m.mail_id""",
        "mail_unique": "SELECT mail, min(ip) AS ip FROM outside GROUP BY mail",
        "last_file_wins": """SELECT mail_id, fichier_id, score FROM (SELECT mail_id, appetence_id AS fichier_id, score,
            row_number() OVER (PARTITION BY mail_id ORDER BY appetence_id DESC) AS rn FROM appetence_match) WHERE rn = 1""",
        "top_birth": """SELECT b.mail, i.id AS identity_id, i.birth FROM base b JOIN id i ON i.mail_id = b.id
            ORDER BY i.birth DESC NULLS FIRST, md5(concat('0:', i.id)), i.id LIMIT 1250""",
        "civility": """SELECT id, CASE civilite WHEN '1.0' THEN 'M' WHEN '2.0' THEN 'MLLE' WHEN '3.0' THEN 'MME'
            ELSE civilite END AS civilite FROM dirty_id""",
        "strip_decimal": """SELECT id, CASE civilite WHEN '1.0' THEN 'M' WHEN '2.0' THEN 'MLLE' WHEN '3.0' THEN 'MME'
            WHEN '4.0' THEN '4' END AS civilite, split_part(cp, '.', 1) AS cp FROM dirty_id""",
        "birth_format": """SELECT id, CASE WHEN id % 4 < 3 THEN strftime(birth, '%Y%m%d000000') END AS birth,
            id % 4 = 3 AS unread FROM dirty_id""",
        "century_repair": """SELECT id, CASE WHEN year(birth) <= 1 THEN NULL WHEN year(birth) <= 1900 OR year(birth) > 2014
            THEN birth + CAST((19 - year(birth) // 100) * 36500 AS INTEGER) ELSE birth END AS birth
            FROM (SELECT id, birth + CAST((id % 4 - 2) * 36500 AS INTEGER) AS birth FROM dirty_id)""",
        "text_rules": """SELECT id, CASE WHEN lower(civilite) <> 'nan' THEN civilite END AS civilite,
            trim(concat('  ', cp, ' ')) AS cp,
            CASE WHEN birth <> DATE '1998-08-02' THEN strftime(birth, '%Y-%m-%d') END AS birth FROM dirty_id""",
        "mail_domain": "SELECT id, domain FROM base",
        "mail_syntax": f"""SELECT DISTINCT doc_id, lower(trim(mail)) AS mail,
            regexp_matches(lower(trim(mail)), '{_ADDRESS}') AS valid FROM ({_WORDS})""",
        "rejected_mails": f"""SELECT DISTINCT doc_id, mail FROM ({_WORDS}) WHERE NOT regexp_matches(lower(trim(mail)), '{_ADDRESS}')""",
        "keyword_flag": f"SELECT b.id, b.mail, {_named('mot')} AS exclusion_mot_cle FROM base b",
        "keyword_hits": "SELECT b.id AS mail_id, m.id AS mot_list_id FROM base b JOIN mot_list m ON contains(b.mail, m.mot)",
        "partner_file": f"""SELECT mail, strftime(date, '%Y%m%d%H%M%S') AS date, ip,
            CASE civilite WHEN '1.0' THEN 'M' WHEN '2.0' THEN 'MLLE' WHEN '3.0' THEN 'MME' ELSE civilite END AS civilite,
            lower(nom) AS nom, lower(prenom) AS prenom, '' AS adresse, cp, lower(ville) AS ville,
            strftime(birth, '%Y%m%d000000') AS birth, 'france' AS pays FROM (
              SELECT DISTINCT b.mail, {ID}, l.ip, l.provenance, l.date {_BASE_ID} LEFT JOIN lead l ON l.mail_id = b.id WHERE {_SEGMENT})""",
        "map_existing": """SELECT i.mail, i.md5, k.md5 IS NOT NULL AS exist, k.md5 IS NULL AS new FROM incoming i
            LEFT JOIN (SELECT DISTINCT md5 FROM md5_table) k ON k.md5 = i.md5""",
        "match_counts": """SELECT count(*) AS initial, count(*) AS sorted,
            count(*) FILTER (WHERE md5 IN (SELECT md5 FROM md5_table)) AS n_exist,
            count(*) FILTER (WHERE md5 NOT IN (SELECT md5 FROM md5_table)) AS n_new FROM incoming""",
        "lookup_hash": """SELECT i.mail, i.md5, k.pg_id, k.md5 IS NOT NULL AS exist, k.md5 IS NULL AS insert FROM incoming i
            LEFT JOIN (SELECT md5, min(mail_id) AS pg_id FROM md5_table GROUP BY md5) k ON k.md5 = i.md5""",
        "interest_lookup": f"""SELECT b.id AS mail_id, b.mail, a.interet, s.score FROM base b JOIN appetence_match s ON s.mail_id = b.id
            JOIN appetence_list a ON a.id = s.appetence_id
            WHERE {_in(_PARTNER, '1-URGENT')} AND NOT {_in(_BROKER, BROKER)}""",
        "hash_enrich": """SELECT o.mail, k.civilite FROM outside o LEFT JOIN (
            SELECT DISTINCT m.md5, i.civilite FROM md5_table m JOIN id i ON i.mail_id = m.mail_id
            JOIN lead l ON l.mail_id = m.mail_id WHERE i.civilite IS NOT NULL AND l.date IS NOT NULL) k ON k.md5 = md5(o.mail)""",
        "append_identity": f"""SELECT o.mail, {ID} FROM (SELECT DISTINCT mail FROM outside) o
            LEFT JOIN base b ON b.mail = o.mail LEFT JOIN id i ON i.mail_id = b.id""",
        "new_rows_diff": f"""SELECT b.mail, b.civilite, b.prenom, b.birth FROM contact_id b WHERE {_in(_PARTNER, '1-URGENT')}
            AND NOT EXISTS (SELECT 1 FROM contact_id o WHERE o.mail = b.mail AND o.civilite IS NOT DISTINCT FROM b.civilite
                AND o.prenom IS NOT DISTINCT FROM b.prenom AND o.birth IS NOT DISTINCT FROM b.birth
                AND ({_in(_BROKER, *BROKERS, k='o.id')} OR {_in(_OPTIN, 'NATION_7', k='o.id')}))
            AND {_without('plainte', 'mot')}""",
        "audit_match": "SELECT b.mail FROM incoming i JOIN md5_table m ON m.md5 = i.md5 JOIN base b ON b.id = m.mail_id",
        "natural_left": f"""SELECT i.mail_id, i.civilite, i.prenom, i.birth, k.known FROM id i LEFT JOIN (
            SELECT DISTINCT mail_id, civilite, prenom, true AS known FROM id i2 WHERE {_in(_BROKER, *BROKERS, k='i2.mail_id')}) k
            ON k.mail_id = i.mail_id AND k.civilite IS NOT DISTINCT FROM i.civilite AND k.prenom IS NOT DISTINCT FROM i.prenom""",
        "segment_sizes": " UNION ALL ".join(f"SELECT '{name}' AS segment, count(*) AS n FROM base b WHERE {where}" for name, where in {
            "partner": _in(_PARTNER, "1-URGENT"), "classic": _SEGMENT, "file": _in(_FILE, FILES[0]) + " AND " + _without("npai"),
            "broker": _in(_BROKER, *BROKERS) + " AND " + _in(_PARTNER, "3-MEDIUM"), "openers": _named("ouvreur") + " AND " + _named("criteo"),
            "campaign": _named("ouvreur_campagne") + " AND " + _without("plainte", "mot"),
            "both files": _in(_FILE, FILES[0]) + " AND " + _in(_FILE, FILES[1]),
            "three partners": " AND ".join(_in(_PARTNER, p) for p in ("1-URGENT", "2-HIGH", "3-MEDIUM")),
            "everyone": _without("mxm", "not_b2c"), "nobody": "false",
        }.items()),
        "overlap_sketched": """SELECT y.fichier_num, count(DISTINCT f.mail_id) AS size, count(DISTINCT n.mail_id) AS n_exist,
            count(DISTINCT f.mail_id) - count(DISTINCT n.mail_id) AS n_new
            FROM fichier_match f JOIN fichier_list y ON y.id = f.fichier_id LEFT JOIN base_npai n ON n.mail_id = f.mail_id
            GROUP BY y.fichier_num""",
        "overlap_by_file": """SELECT y.fichier_num, count(*) AS initial, count(*) AS sorted,
            count(*) FILTER (WHERE n.mail_id IS NOT NULL) AS n_exist, count(*) FILTER (WHERE n.mail_id IS NULL) AS n_new
            FROM fichier_match f JOIN fichier_list y ON y.id = f.fichier_id LEFT JOIN base_npai n ON n.mail_id = f.mail_id
            GROUP BY y.fichier_num""",
        "hash_backfill": f"""SELECT b.id AS mail_id, md5(b.mail) AS md5 FROM base b WHERE NOT {_in(_PARTNER, '1-URGENT')}""",
        "reach_counts": f"""SELECT count(DISTINCT b.id) AS n_mail, count(DISTINCT s.port) AS n_sms, count(DISTINCT i.cp) AS n_cp
            FROM base b RIGHT JOIN sms s ON s.mail_id = b.id RIGHT JOIN id i ON i.mail_id = b.id WHERE {_in(_BROKER_ID, 9)}""",
        "reach_profile": f"""SELECT count(DISTINCT b.mail) AS mail, count(s.port) AS sms, count(i.cp) AS cp FROM base b
            LEFT JOIN sms s ON s.mail_id = b.id LEFT JOIN id_unik i ON i.mail_id = b.id WHERE {_in(_BROKER_ID, 1, 2, 4, 6, 9)}""",
        "file_sizes": "SELECT fichier_id, count(*) AS n, count(*) // 1000 AS thousands FROM fichier_match GROUP BY fichier_id",
        "ip_pool": "SELECT ip FROM lead UNION SELECT ip FROM campagne_ouvreur",
        "in_common": "SELECT l.mail_id, l.ip, l.provenance, l.date FROM lead l WHERE l.mail_id IN (SELECT mail_id FROM campagne_ouvreur)",
        "table_query": """SELECT l.abreviation, count(DISTINCT m.mail_id) AS n_mail FROM regie_match m
            JOIN regie_list l ON l.id = m.regie_id GROUP BY l.abreviation""",
        "exact_sample": "SELECT id, mail_id FROM id ORDER BY md5(concat('11:', id)), id LIMIT 1200",
        "random_split": f"""SELECT b.id, b.mail, CAST(CAST('0x' || substr(md5(concat('11:', b.mail)), 1, 8) AS BIGINT) % 5 AS INTEGER) AS part
            FROM base b WHERE NOT {_named('ouvreur')}
            UNION ALL SELECT b.id, b.mail, CAST(unnest([0, 1, 2, 3, 4]) AS INTEGER) AS part FROM base b WHERE {_named('ouvreur')}""",
        "first_part": f"""SELECT b.mail, i.civilite, i.nom, i.prenom, '' AS telephone, i.birth, i.cp, i.ville, 'France' AS pays,
            '' AS date_collecte {_BASE_ID} WHERE {_named('ouvreur')}
            OR CAST('0x' || substr(md5(concat('11:', b.mail)), 1, 8) AS BIGINT) % 5 = 0""",
        "sampled_extract": f"SELECT b.mail FROM base b WHERE {_without('plainte')} ORDER BY md5(concat('0:', b.mail)) LIMIT 100",
        "chunks": """SELECT mail, least((rn - 1) // 400 + 1, n // 400) AS chunk FROM (
            SELECT mail, row_number() OVER (ORDER BY mail) AS rn, count(*) OVER () AS n FROM base)""",
        "filename_schema": f"""SELECT name, {_NUMBER} AS number, concat('mail|civilite|', regexp_extract(name, ',([a-z0-9 ]*)\\]', 1)) AS header,
            CASE WHEN contains(name, '[ouvreur]') THEN 'ouvreur' WHEN contains(name, '[regie:ads]') THEN 'ads' ELSE '' END AS statuses,
            CASE WHEN contains(name, '[regie:ads]') THEN 'ads' END AS broker,
            CAST(regexp_extract(name, '_(\\d+)k\\.csv$', 1) AS INTEGER) AS thousands, name LIKE 'OK%' AS done FROM ({_NAMES})""",
        "file_order": f"""SELECT name, row_number() OVER (ORDER BY {_NUMBER} NULLS LAST, name) AS place
            FROM (SELECT DISTINCT name FROM ({_NAMES})) WHERE name NOT LIKE 'OK%' AND name NOT LIKE 'PB%'""",
    }
    statuses = """SELECT b.mail, 1 AS place, 'ads' AS status FROM base b JOIN lead l ON l.mail_id = b.id
        UNION ALL SELECT b.mail, 2, '' FROM base b JOIN regie_actif a ON a.mail_id = b.id
        UNION ALL SELECT b.mail, 3, 'desabo' FROM base b WHERE b.id IN (SELECT mail_id FROM optin_desabo)
        UNION ALL SELECT b.mail, 4, 'ouvreur' FROM base b WHERE b.id IN (SELECT mail_id FROM base_ouvreur)
        UNION ALL SELECT b.mail, 5, 'plainte' FROM base b WHERE b.id IN (SELECT mail_id FROM base_plainte)"""
    stranger = "concat(lower(replace(abreviation,'#','.')),'@supplier.example')"
    added = f"""SELECT (SELECT max(id) FROM base) + row_number() OVER (ORDER BY mail) AS id, mail, abreviation
        FROM (SELECT DISTINCT {stranger} AS mail, abreviation FROM regie_list)"""
    files = {
        "csv_round_trip": """SELECT CAST(mail_id AS VARCHAR) AS mail_id, civilite, prenom, nom, cp, ville,
            CAST(birth AS VARCHAR) AS birth FROM id""",
        "folder_segment": f"""SELECT b.mail, CAST(max(x.place) AS DOUBLE) AS number FROM base b JOIN ({statuses}) x ON x.mail = b.mail
            WHERE x.place <= 2 AND NOT EXISTS (SELECT 1 FROM optin_desabo d WHERE d.mail_id = b.id)
            AND {_without('plainte', 'npai', 'mot')} GROUP BY b.mail""",
        "status_flags": f"""SELECT DISTINCT mail, CAST(place AS BIGINT) AS place, CASE status WHEN 'desabo' THEN true END AS desabo,
            CASE status WHEN 'ouvreur' THEN true END AS ouvreur, CASE status WHEN 'plainte' THEN true END AS plainte
            FROM ({statuses})""",
        "mails_of_files": f"SELECT mail FROM ({statuses})",
        "folder_union": f"SELECT DISTINCT mail FROM ({statuses})",
        "import_contacts": f"SELECT id, mail, 'supplier.example' AS domain FROM ({added})",
        "import_roundtrip": """SELECT DISTINCT b.mail, l.ip, l.provenance, strftime(l.date, '%Y-%m-%d %H:%M:%S') AS at
            FROM base b JOIN lead l ON l.mail_id = b.id""",
        "import_rerun": f"""SELECT row_number() OVER (ORDER BY load, mail) AS id, mail FROM (
              SELECT mail, min(load) AS load FROM (
                SELECT b.mail, 1 AS load FROM base b WHERE b.id IN (SELECT mail_id FROM lead UNION SELECT mail_id FROM base_ouvreur UNION SELECT mail_id FROM base_npai)
                UNION ALL SELECT b.mail, 2 FROM base b WHERE b.id IN (SELECT mail_id FROM sms) UNION ALL SELECT {stranger}, 2 FROM regie_list)
              GROUP BY mail)""",
        "import_stopped": """SELECT row_number() OVER (ORDER BY mail) AS id, mail, CAST(0 AS BIGINT) AS seen_before FROM base
            WHERE id IN (SELECT mail_id FROM lead UNION SELECT mail_id FROM base_ouvreur UNION SELECT mail_id FROM base_npai)""",
        "stream_merge": """SELECT b.mail, x.ip, x.provenance, b.id IN (SELECT mail_id FROM lead UNION SELECT mail_id FROM base_ouvreur) AS opener
            FROM base b JOIN (SELECT DISTINCT mail_id, ip, provenance FROM lead
              UNION SELECT mail_id, '0.0.0.0', 'later' FROM base_ouvreur) x ON x.mail_id = b.id""",
        "mixed_encodings": """SELECT b.mail, translate(i.prenom, 'aeioubcd', 'àéîôùßçñ') AS prenom, CAST(n AS DOUBLE) AS number
            FROM base b JOIN id i ON i.mail_id = b.id, (SELECT unnest([1, 2, 3]) AS n)""",
        "import_two_folders": f"""SELECT fichier_num, count(DISTINCT mail) AS contacts, CAST(1 AS BIGINT) AS files FROM (
              SELECT '305' AS fichier_num, b.mail FROM base b JOIN lead l ON l.mail_id = b.id
              UNION ALL SELECT '306', b.mail FROM base b JOIN base_ouvreur o ON o.mail_id = b.id
              UNION ALL SELECT '307', b.mail FROM base b JOIN base_npai n ON n.mail_id = b.id
              UNION ALL SELECT '1', b.mail FROM base b JOIN lead l ON l.mail_id = b.id
              UNION ALL SELECT '2', {stranger} FROM regie_list
              UNION ALL SELECT '3', b.mail FROM base b JOIN sms s ON s.mail_id = b.id) GROUP BY fichier_num""",
        "import_status": "SELECT mail FROM base WHERE id IN (SELECT mail_id FROM base_ouvreur)",
        "import_broker": "SELECT mail, 'ads' AS abreviation FROM base WHERE id IN (SELECT mail_id FROM base_npai)",
        "import_rejects": """SELECT 'mail' AS field, 'not well formed' AS reason, count(*) AS n, min(replace(b.mail, '@', ' at ')) AS least
            FROM base b JOIN id i ON i.mail_id = b.id WHERE i.id % 7 = 0
            UNION ALL SELECT 'birth', 'unread', count(*), min(concat('year ', CAST(year(i.birth) AS VARCHAR)))
            FROM base b JOIN id i ON i.mail_id = b.id WHERE i.id % 7 <> 0 AND i.id % 5 = 0""",
        "import_bad_file": """SELECT CAST(1 AS BIGINT) AS place, count(*) AS lines, count(*) FILTER (WHERE i.id % 7 = 0) AS rejected,
            count(*) FILTER (WHERE i.id % 7 <> 0 AND i.id % 5 = 0) AS unread_birth, 'OK' AS status, NULL AS error
            FROM base b JOIN id i ON i.mail_id = b.id
            UNION ALL SELECT 2, 0, 0, 0, 'PB', 'the name gives no mail column' UNION ALL SELECT 3, 0, 0, 0, 'PB', 'no content'""",
        "import_mails_only": """SELECT mail, domain FROM base WHERE id IN (SELECT mail_id FROM lead UNION SELECT mail_id FROM sms)
            AND NOT regexp_matches(mail, 'building|supplier')""",
        "import_scores": """SELECT DISTINCT b.mail, 'travel' AS interet, m.regie_id / 4 AS score FROM base b JOIN regie_match m ON m.mail_id = b.id""",
        "stream_wide": "SELECT mail, domain, CAST(id AS VARCHAR) AS c7 FROM base",
        "text_file_ragged": """SELECT mail, CASE WHEN id % 3 > 0 THEN domain END AS domain,
            CASE WHEN id % 3 = 2 THEN CAST(id AS VARCHAR) END AS unknown_1, CASE WHEN id % 3 = 2 THEN 'y' END AS unknown_3 FROM base""",
        "import_leads": "SELECT DISTINCT mail_id, ip, provenance FROM lead",
        "import_identities": f"SELECT id AS mail_id, abreviation AS prenom FROM ({added})",
        "import_report": f"""SELECT CAST(place AS BIGINT) AS place, count(*) AS initial, count(*) FILTER (WHERE k) AS n_exist,
            count(*) FILTER (WHERE NOT k) AS n_new, 'OK' AS status FROM (
              SELECT DISTINCT 1 AS place, true AS k, CAST(l.mail_id AS VARCHAR), l.ip, l.provenance FROM lead l JOIN base b ON b.id = l.mail_id
              UNION ALL SELECT DISTINCT 2, false, abreviation, NULL, NULL FROM regie_list
              UNION ALL SELECT DISTINCT 3, true, b.mail, CAST(s.port AS VARCHAR), NULL FROM sms s JOIN base b ON b.id = s.mail_id)
            GROUP BY place""",
        "stream_import": f"""SELECT b.mail, l.ip, NULL AS prenom, NULL AS port, CAST(1 AS DOUBLE) AS number FROM base b JOIN lead l ON l.mail_id = b.id
            UNION ALL SELECT {stranger}, NULL, abreviation, NULL, 2 FROM regie_list
            UNION ALL SELECT b.mail, NULL, NULL, CAST(s.port AS VARCHAR), 3 FROM base b JOIN sms s ON s.mail_id = b.id""",
        "export_manifest": f"""SELECT concat('ExportMail-MailUnik_2015-11-19_[mail,civilite,prenom,nom,cp,ville,birth]_', n // 1000, 'k.csv') AS name,
            n AS rows FROM (SELECT count(DISTINCT b.mail) AS n {_BASE_ID} WHERE {_SEGMENT})""",
        "broker_membership": f"""SELECT b.id AS mail_id, CAST(3 AS BIGINT) AS regie_id FROM base b WHERE {_in(_PARTNER, '3-MEDIUM')}
            AND {_without(*PARTNER_OUT)} AND NOT {_in(_BROKER, BROKER)}""",
        "replaced_table": "SELECT * FROM id_unik",
        "replaced_in_store": "SELECT * FROM id_unik",
        "stored_membership": f"""SELECT b.id AS mail_id, CAST(3 AS BIGINT) AS regie_id FROM base b WHERE {_in(_PARTNER, '3-MEDIUM')}
            AND {_without(*PARTNER_OUT)} AND NOT {_in(_BROKER, BROKER)}""",
        "aliased_columns": f"""SELECT b.mail, i.civilite AS civi, i.prenom AS firstname, i.nom AS name, i.cp AS codepostal,
            i.ville AS city, i.birth AS naissance {_BASE_ID} WHERE {_without('npai')}""",
        "text_file": "SELECT mail, 'x' AS a, 'y' AS unknown_1 FROM outside",
    }
    texts.update(files)
    texts["group_packing"] = """, counts AS MATERIALIZED (
          SELECT fichier_id, count(*) AS n, row_number() OVER (ORDER BY fichier_id) AS k FROM fichier_match GROUP BY fichier_id),
        packed AS (
          SELECT k, fichier_id, n AS held, CAST(1 AS BIGINT) AS file_number FROM counts WHERE k = 1
          UNION ALL SELECT c.k, c.fichier_id, CASE WHEN p.held > 5000 THEN c.n ELSE p.held + c.n END,
            CASE WHEN p.held > 5000 THEN p.file_number + 1 ELSE p.file_number END
          FROM packed p JOIN counts c ON c.k = p.k + 1)
        SELECT m.fichier_id, m.mail_id, p.file_number FROM fichier_match m JOIN packed p ON p.fichier_id = m.fichier_id"""
    return {name: _sql(text) for name, text in texts.items()}
