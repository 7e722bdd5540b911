"""What each registered query must return, as SQL over the driver tables.

Written on its own, from the rules and not from the engine's expressions: dates are parsed
from text, labels are joined, and the wide view joins the star tables. The code labels are
fixed values, stated here a second time so that a wrong label in the engine shows.
"""

from __future__ import annotations

_RAW = """
raw AS (
  SELECT
    CAST(o_orderkey + 1 AS BIGINT) AS "CONTADOR",
    CAST(CASE WHEN o_orderkey % 59 = 0 THEN 119999 ELSE 110001 + c_nationkey END AS BIGINT)
      AS "CODMUNNASC",
    CAST(CASE WHEN o_orderkey % 53 = 0 THEN 9 ELSE 1 + o_orderkey % 5 END AS BIGINT) AS "LOCNASC",
    CAST(CASE WHEN o_orderkey % 37 = 0 THEN 9
         ELSE CAST(substr(o_orderpriority, 1, 1) AS INT) END AS BIGINT) AS "ESTCIVMAE",
    CAST(o_orderkey % 14 AS BIGINT) AS "ESCMAE",
    CAST(CASE WHEN o_orderkey % 61 = 0 THEN 9000000000000 ELSE o_custkey END AS BIGINT) AS "CODOCUPMAE",
    CAST(o_orderkey % 13 AS BIGINT) AS "QTDFILVIVO",
    CAST((o_orderkey * 7) % 12 AS BIGINT) AS "QTDFILMORT",
    CAST(CASE WHEN o_orderkey % 41 = 0 THEN 9 ELSE 1 + o_orderkey % 6 END AS BIGINT) AS "GESTACAO",
    CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 9 END AS BIGINT) AS "PARTO",
    CAST(1 + o_orderkey % 4 AS BIGINT) AS "CONSULTAS",
    CAST(extract(day FROM o_orderdate) * 1000000 + extract(month FROM o_orderdate) * 10000
         + extract(year FROM o_orderdate) AS BIGINT) AS "DTNASC",
    CAST(o_orderkey % 3 AS BIGINT) AS "SEXO",
    CAST(1 + (o_orderkey * 3) % 5 AS BIGINT) AS "RACACOR",
    CAST((1 + o_orderkey % 28) * 1000000 + (1 + o_orderkey % 12) * 10000
         + (CASE WHEN o_orderkey % 31 = 0 THEN 2014 WHEN o_orderkey % 23 = 0 THEN 1949
            ELSE 1950 + o_orderkey % 36 END) AS BIGINT) AS "DTNASCMAE",
    CAST(1 + (o_orderkey + 2) % 5 AS BIGINT) AS "RACACORMAE",
    CAST(CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE o_orderkey % 13 END AS BIGINT) AS "ESCMAEAGR1"
  FROM orders JOIN customer ON o_custkey = c_custkey
)"""

_SPOILED = _RAW + """,
spoiled AS (
  SELECT * REPLACE (CASE WHEN ("CONTADOR" - 1) % 97 = 0 THEN 32011990 ELSE "DTNASC" END AS "DTNASC")
  FROM raw
)"""


# Births four years later, of other mothers, with the numbers of the first.
_LATER = _RAW + """,
later AS (
  SELECT * REPLACE (
    "DTNASC" + 4 AS "DTNASC", "DTNASCMAE" - 1 AS "DTNASCMAE",
    CAST("CONTADOR" % 14 AS BIGINT) AS "ESCMAE")
  FROM raw
),
both_files AS (SELECT * FROM raw UNION SELECT * FROM later)"""


def _births(source: str) -> str:
    """Complete, parsed, and clean births of a table with raw rows."""
    return f"""
complete AS (SELECT * FROM {source} WHERE "ESCMAEAGR1" IS NOT NULL),
parsed AS (
  SELECT * REPLACE (
    CAST(try_strptime(lpad(CAST("DTNASC" AS VARCHAR), 8, '0'), '%d%m%Y') AS DATE) AS "DTNASC",
    CAST(try_strptime(lpad(CAST("DTNASCMAE" AS VARCHAR), 8, '0'), '%d%m%Y') AS DATE) AS "DTNASCMAE")
  FROM complete
),
clean AS (
  SELECT * FROM parsed
  WHERE "DTNASC" IS NOT NULL
    AND "DTNASCMAE" >= DATE '1950-01-01' AND "DTNASCMAE" < DATE '2014-01-01'
    AND "QTDFILVIVO" <= 10 AND "QTDFILMORT" <= 10
)"""


_CLEAN = _RAW + "," + _births("raw")
_CLEAN_LENIENT = _SPOILED + "," + _births("spoiled")
_CLEAN_BOTH = _LATER + "," + _births("both_files")

_REFERENCE = """
municipality AS (
  SELECT CAST(110001 + n_nationkey AS VARCHAR) AS code, n_name AS name,
         CASE r_name WHEN 'AFRICA' THEN 'AF' WHEN 'AMERICA' THEN 'AM' WHEN 'ASIA' THEN 'AS'
                     WHEN 'EUROPE' THEN 'EU' END AS state
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
occupation AS (SELECT c_custkey AS code, c_name AS title FROM customer)"""

_LABELS = """
education(code, label) AS (VALUES
  (0, 'Sem Escolaridade'), (1, 'Fundamental I Incompleto'), (2, 'Fundamental I Completo'),
  (3, 'Fundamental II Incompleto'), (4, 'Fundamental II Completo'),
  (5, 'Ensino Médio Incompleto'), (6, 'Ensino Médio Completo'), (7, 'Superior Incompleto'),
  (8, 'Superior Completo'), (9, 'Ignorado'), (10, 'Fundamental I Incompleto ou Inespecífico'),
  (11, 'Fundamental II Incompleto ou Inespecífico'),
  (12, 'Ensino Médio Incompleto ou Inespecífico')),
visits(code, label) AS (VALUES
  (1, 'Nenhuma'), (2, 'de 1 a 3'), (3, 'de 4 a 6'), (4, '7 e mais'), (9, 'Ignorado')),
sex(code, label) AS (VALUES (1, 'M – Masculino'), (2, 'F – Feminino'), (0, 'I – Ignorado')),
delivery(code, label) AS (VALUES (1, 'Vaginal'), (2, 'Cesário'), (9, 'Ignorado')),
gestation(code, label) AS (VALUES
  (1, 'Menos de 22 semanas'), (2, '22 a 27 semanas'), (3, '28 a 31 semanas'),
  (4, '32 a 36 semanas'), (5, '37 a 41 semanas'), (6, '42 semanas e mais'), (9, 'Ignorado')),
pregnancy(code, label) AS (VALUES
  ('1', 'Única'), ('2', 'Dupla'), ('3', 'Tripla ou mais'), ('9', 'Ignorado')),
race(code, label) AS (VALUES
  (1, 'Branca'), (2, 'Preta'), (3, 'Amarela'), (4, 'Parda'), (5, 'Indígena')),
marital(code, label) AS (VALUES
  (1, 'Solteira'), (2, 'Casada'), (3, 'Viúva'), (4, 'Separada judicialmente/divorciada'),
  (5, 'União estável'), (9, 'Ignorada')),
place(code, label) AS (VALUES
  (1, 'Hospital'), (2, 'Outros estabelecimentos de saúde'), (3, 'Domicílio'), (4, 'Outros'),
  (5, 'Aldeia Indígena'))"""

_PAIR_KEY = """CAST(CAST(b."PARTO" AS VARCHAR) || CAST(b."SEXO" AS VARCHAR) AS BIGINT)"""


def _fact(date: str, race: str, place: str) -> str:
    return f"""
  SELECT b."CONTADOR" AS id_mae, {date} AS id_calendario, b."CODMUNNASC" AS id_codmunnasc,
         {_PAIR_KEY} AS id_parto_sexo, b."CONSULTAS" AS id_consulta,
         race.label AS raca_nascidos, place.label AS local_nascimento
  FROM (SELECT DISTINCT "CONTADOR", "DTNASC", "CODMUNNASC", "PARTO", "SEXO", "CONSULTAS", "RACACOR",
               "LOCNASC" FROM clean) b
  LEFT JOIN race ON race.code = b."{race}" LEFT JOIN place ON place.code = b."{place}\""""


def _mother(date: str) -> str:
    return f"""
  SELECT b."CONTADOR" AS id_mae, b."ESCMAE" AS id_escmae, b."CODOCUPMAE" AS id_codocupmae,
         {date} AS dtnascmae, b."GESTACAO" AS id_gestacao, race.label AS raca_mae,
         marital.label AS estado_civil, b."QTDFILVIVO" AS qtd_filhovivo,
         b."QTDFILMORT" AS qtd_filhomorto
  FROM (SELECT DISTINCT "CONTADOR", "ESCMAE", "CODOCUPMAE", "DTNASCMAE", "GESTACAO", "RACACORMAE",
               "ESTCIVMAE", "QTDFILVIVO", "QTDFILMORT" FROM clean) b
  LEFT JOIN race ON race.code = b."RACACORMAE" LEFT JOIN marital ON marital.code = b."ESTCIVMAE\""""


def _code_dimension(column: str, labels: str, key: str, label: str) -> str:
    return f"""
  SELECT b.code AS {key}, l.label AS {label}
  FROM (SELECT DISTINCT "{column}" AS code FROM clean) b LEFT JOIN {labels} l ON l.code = b.code"""


_STAR = f"""{_CLEAN},{_REFERENCE},{_LABELS},
dim_municipio AS (
  SELECT DISTINCT CAST(m.code AS BIGINT) AS id_codmunicipionasc, m.name AS cidade, m.state AS estado
  FROM clean b JOIN municipality m ON m.code = CAST(b."CODMUNNASC" AS VARCHAR)
),
dim_profissao AS (
  SELECT DISTINCT o.code AS id_ocupmae, o.title AS ocupacao
  FROM clean b JOIN occupation o ON o.code = b."CODOCUPMAE"
),
dim_escolaridade AS ({_code_dimension("ESCMAE", "education", "id_escmae", "escolaridade")}),
dim_consultas AS ({_code_dimension("CONSULTAS", "visits", "id_consultas", "descricao")}),
dim_gestacao AS ({_code_dimension("GESTACAO", "gestation", "id_gestacao", "descricao_semanas")}),
dim_parto_sexo AS (
  SELECT {_PAIR_KEY} AS id_parto_sexo, sex.label AS sexo, delivery.label AS parto
  FROM (SELECT DISTINCT "SEXO", "PARTO" FROM clean) b
  LEFT JOIN sex ON sex.code = b."SEXO" LEFT JOIN delivery ON delivery.code = b."PARTO"
),
dim_mae AS ({_mother('b."DTNASCMAE"')}),
fact AS ({_fact('b."DTNASC"', "RACACOR", "LOCNASC")})"""

_WIDE = f"""{_STAR},
wide AS (
  SELECT f.*, m.* EXCLUDE (id_mae), e.escolaridade, g.descricao_semanas,
         c.descricao AS descricao_consultas, p.sexo, p.parto, u.cidade, u.estado, o.ocupacao,
         CASE u.estado WHEN 'AF' THEN 'AFRICA' WHEN 'AM' THEN 'AMERICA' WHEN 'AS' THEN 'ASIA'
                       WHEN 'EU' THEN 'EUROPE' END AS regiao,
         date_diff('year', m.dtnascmae, f.id_calendario)
           - CASE WHEN strftime(f.id_calendario, '%m%d') < strftime(m.dtnascmae, '%m%d')
                  THEN 1 ELSE 0 END AS idade
  FROM fact f
  LEFT JOIN dim_mae m ON m.id_mae = f.id_mae
  LEFT JOIN dim_escolaridade e ON e.id_escmae = m.id_escmae
  LEFT JOIN dim_gestacao g ON g.id_gestacao = m.id_gestacao
  LEFT JOIN dim_profissao o ON o.id_ocupmae = m.id_codocupmae
  LEFT JOIN dim_consultas c ON c.id_consultas = f.id_consulta
  LEFT JOIN dim_parto_sexo p ON p.id_parto_sexo = f.id_parto_sexo
  LEFT JOIN dim_municipio u ON u.id_codmunicipionasc = f.id_codmunnasc
)"""

_BIRTH_COLUMNS = """
  "CONTADOR", "CODMUNNASC", "LOCNASC", "ESTCIVMAE", "ESCMAE", "CODOCUPMAE", "QTDFILVIVO",
  "QTDFILMORT", "GESTACAO", "PARTO", "CONSULTAS", "DTNASC", "SEXO", "RACACOR", "DTNASCMAE",
  "RACACORMAE", "ESCMAEAGR1\""""


def _select(ctes: str, query: str) -> str:
    return f"WITH {ctes}\n{query}"


def _summary(table: str, key: str, name: str | None = None) -> str:
    return f"""
SELECT '{name or table}' AS tabela, CAST(count(*) AS BIGINT) AS linhas,
       count(DISTINCT {key}) AS chaves,
       (SELECT count(*) FROM (SELECT {key} FROM {table} GROUP BY {key} HAVING count(*) > 1))
         AS chaves_repetidas
FROM {table}"""


_TABLES = [
    ("dim_municipio", "id_codmunicipionasc", None),
    ("dim_profissao", "id_ocupmae", None),
    ("dim_escolaridade", "id_escmae", None),
    ("dim_consultas", "id_consultas", None),
    ("dim_parto_sexo", "id_parto_sexo", None),
    ("dim_gestacao", "id_gestacao", None),
    ("dim_mae", "id_mae", None),
    ("fact", "id_mae", "fatos_nascidos"),
]

_UNKNOWN = "'Desconhecido'"


def _counted(label: str, alias: str | None = None) -> str:
    named = alias or label
    return f"""
SELECT coalesce({label}, {_UNKNOWN}) AS {named}, count(*) AS nascimentos FROM wide GROUP BY 1"""


_SAMPLED = _CLEAN + """,
sampled AS (
  SELECT * FROM clean ORDER BY md5('42|' || CAST("CONTADOR" AS VARCHAR)), "CONTADOR" LIMIT 1000
)"""

_SILVER = f"SELECT {_BIRTH_COLUMNS} FROM clean"

_VIEWS = [
    "fatos_nascidos", "dim_mae", "registros", "direto", "larga", "larga_do_esquema", "escolaridade",
    "estado_civil", "mes",
]

_CHOSEN = """wide
WHERE parto IN ('Vaginal', 'Cesário') AND (estado IN ('AF', 'AS') OR estado IS NULL)
  AND estado_civil = 'Casada'"""

_AGE_BAND = """CASE WHEN idade < 0 THEN 'invalid' WHEN idade < 15 THEN '<15'
            WHEN idade <= 19 THEN '15-19' WHEN idade <= 24 THEN '20-24'
            WHEN idade <= 29 THEN '25-29' WHEN idade <= 34 THEN '30-34'
            WHEN idade <= 39 THEN '35-39' WHEN idade <= 44 THEN '40-44' ELSE '45+' END
         AS faixa_etaria"""

_FIELDS = [name.strip().strip('"') for name in _BIRTH_COLUMNS.split(",")]
_LINE = "concat_ws(';', " + ", ".join(f"coalesce(CAST(\"{n}\" AS VARCHAR), '')" for n in _FIELDS) + ", 'x')"

ORACLE: dict[str, str] = {
    "births_dropna": _select(_CLEAN, f"SELECT {_BIRTH_COLUMNS} FROM complete"),
    "births_parsed_dates": _select(_CLEAN, 'SELECT "CONTADOR", "DTNASC", "DTNASCMAE" FROM parsed'),
    "births_lenient_dates": _select(
        _CLEAN_LENIENT, 'SELECT "CONTADOR", "DTNASC", "DTNASCMAE" FROM parsed'
    ),
    "births_filtered": _select(
        _CLEAN, 'SELECT "CONTADOR", "DTNASCMAE", "QTDFILVIVO", "QTDFILMORT" FROM clean'
    ),
    "births_clean": _select(_CLEAN, _SILVER),
    "births_clean_lenient": _select(_CLEAN_LENIENT, _SILVER),
    "births_rejects": _select(
        _CLEAN_LENIENT,
        f"""SELECT {_BIRTH_COLUMNS}, 'DTNASC' AS motivo FROM complete
WHERE try_strptime(lpad(CAST("DTNASC" AS VARCHAR), 8, '0'), '%d%m%Y') IS NULL""",
    ),
    "births_strict_violations": _select(
        _CLEAN_LENIENT,
        """SELECT "CONTADOR", 'DTNASC' AS motivo FROM complete
WHERE try_strptime(lpad(CAST("DTNASC" AS VARCHAR), 8, '0'), '%d%m%Y') IS NULL""",
    ),
    "sample_tied_timestamps": """
WITH sizes AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1),
placed AS (
  SELECT event_type, n,
         sum(n) OVER (ORDER BY md5('42|' || event_type)) - n AS before
  FROM sizes
)
SELECT event_type, CAST(least(n, 1000 - before) AS BIGINT) AS linhas FROM placed WHERE before < 1000""",
    "codes_beyond_double": (
        "SELECT o_orderkey, CAST(o_orderkey + 9007199254740993 AS BIGINT) AS codigo FROM orders"
    ),
    "births_csv_rejects": _select(
        _RAW,
        f"""SELECT CAST("CONTADOR" AS VARCHAR) AS "CONTADOR", {_LINE} AS linha, 'campos demais' AS motivo
FROM raw WHERE "CONTADOR" % 50 = 0""",
    ),
    "births_csv_lineage": _select(
        _RAW,
        """SELECT CASE WHEN "CONTADOR" % 50 = 0 THEN 'campos demais'
            WHEN "CONTADOR" % 51 = 0 OR "ESCMAEAGR1" IS NULL THEN 'incompleta' ELSE 'completa' END AS veredito,
       CASE "CONTADOR" % 2 WHEN 0 THEN 'pares' ELSE 'impares' END AS pasta,
       count(*) AS linhas, CAST(sum("CONTADOR") AS BIGINT) AS soma_contador
FROM raw GROUP BY 1, 2""",
    ),
    "births_sample_exact": _select(_SAMPLED, f"SELECT {_BIRTH_COLUMNS} FROM sampled"),
    "births_csv_scan": _select(_CLEAN, _SILVER),
    "municipality_csv_scan": _select(
        _REFERENCE,
        """SELECT code AS "Codigo_Municipio_Completo", name AS "Nome_Municipio", state AS "UF"
FROM municipality""",
    ),
    "occupation_csv_scan": _select(
        _REFERENCE, 'SELECT code AS "CODIGO", title AS "TITULO" FROM occupation'
    ),
    "municipality_prepared": _select(
        _REFERENCE,
        """SELECT code AS "Codigo_Municipio_Completo", name AS "Nome_Municipio", state AS "UF"
FROM municipality""",
    ),
    "occupation_prepared": _select(
        _REFERENCE, 'SELECT code AS "CODIGO", title AS "TITULO" FROM occupation'
    ),
    "join_municipality": _select(
        f"{_CLEAN},{_REFERENCE}",
        """SELECT b."CODMUNNASC", m.name AS "Nome_Municipio", m.state AS "UF"
FROM clean b JOIN municipality m ON m.code = CAST(b."CODMUNNASC" AS VARCHAR)""",
    ),
    "join_occupation": _select(
        f"{_CLEAN},{_REFERENCE}",
        """SELECT b."CODOCUPMAE", o.title AS "TITULO"
FROM clean b JOIN occupation o ON o.code = b."CODOCUPMAE\"""",
    ),
    "dim_municipio": _select(_STAR, "SELECT * FROM dim_municipio"),
    "dim_profissao": _select(_STAR, "SELECT * FROM dim_profissao"),
    "dim_escolaridade": _select(_STAR, "SELECT * FROM dim_escolaridade"),
    "dim_escolaridade_grouped": _select(
        _STAR, _code_dimension("ESCMAEAGR1", "education", "id_escmae", "escolaridade")
    ),
    "dim_consultas": _select(_STAR, "SELECT * FROM dim_consultas"),
    "dim_gestacao": _select(_STAR, "SELECT * FROM dim_gestacao"),
    "dim_parto_sexo": _select(_STAR, "SELECT * FROM dim_parto_sexo"),
    "dim_mae": _select(_STAR, "SELECT * FROM dim_mae"),
    "dim_mae_compat": _select(
        _STAR, _mother("""rtrim(CAST(b."DTNASCMAE" AS VARCHAR) || ' 00:00:00', ' 0:')""")
    ),
    "fact_births": _select(_STAR, "SELECT * FROM fact"),
    "fact_births_compat": _select(
        _STAR,
        _fact("""rtrim(CAST(b."DTNASC" AS VARCHAR) || ' 00:00:00', ' 0:')""", "CONSULTAS", "RACACOR"),
    ),
    "decode_pregnancy": _select(
        _LABELS,
        """SELECT t.code AS "GRAVIDEZ", count(*) AS nascimentos, p.label AS descricao
FROM (SELECT CASE WHEN o_orderkey % 4 = 3 THEN '9' ELSE CAST(1 + o_orderkey % 4 AS VARCHAR) END AS code
      FROM orders JOIN customer ON o_custkey = c_custkey) t
LEFT JOIN pregnancy p ON p.code = t.code GROUP BY 1, 3""",
    ),
    "birth_profile": _select(
        _WIDE, "SELECT * EXCLUDE (cidade, estado, ocupacao, regiao, idade) FROM wide"
    ),
    "births_wide": _select(_WIDE, "SELECT * EXCLUDE (regiao, idade) FROM wide"),
    "births_wide_from_star": _select(_WIDE, "SELECT * EXCLUDE (regiao, idade) FROM wide"),
    "orphan_municipality": _select(
        _WIDE,
        """SELECT id_codmunnasc, count(*) AS nascimentos FROM fact
WHERE id_codmunnasc NOT IN (SELECT id_codmunicipionasc FROM dim_municipio) GROUP BY 1""",
    ),
    "orphan_occupation": _select(
        _WIDE,
        """SELECT id_codocupmae, count(*) AS nascimentos FROM dim_mae
WHERE id_codocupmae NOT IN (SELECT id_ocupmae FROM dim_profissao) GROUP BY 1""",
    ),
    "dimension_key_check": _select(_STAR, "\nUNION ALL\n".join(_summary(*t) for t in _TABLES)),
    "births_total_by_view": _select(
        _CLEAN_BOTH,
        "\nUNION ALL\n".join(
            f"SELECT '{view}' AS visao, CAST(count(*) AS BIGINT) AS nascimentos FROM clean"
            for view in _VIEWS
        ),
    ),
    "append_two_years": _select(
        _CLEAN_BOTH,
        """SELECT "CONTADOR" AS id_mae, year("DTNASC") AS ano, "DTNASC" AS id_calendario,
       "DTNASCMAE" AS dtnascmae, "ESCMAE" AS id_escmae FROM clean""",
    ),
    "append_new_label": _select(
        _STAR,
        """SELECT * FROM dim_profissao
UNION ALL SELECT id_ocupmae, ocupacao || ' *' FROM dim_profissao WHERE id_ocupmae % 4 = 0""",
    ),
    **{f"stored_{name or table}": _select(_STAR, f"SELECT * FROM {table}") for table, _, name in _TABLES},
    "stored_registros": _select(_CLEAN, _SILVER),
    "sink_append_twice": _select(_STAR, "SELECT * FROM fact UNION ALL SELECT * FROM fact"),
    "sink_append_new_only": _select(_STAR, "SELECT * FROM fact"),
    "sink_overwrite": _select(_STAR, "SELECT * FROM fact"),
    "warehouse_tables": _select(
        _STAR,
        "\nUNION ALL\n".join(
            f"""SELECT '{name or table}' AS tabela, count(*) AS linhas,
       CAST(sum({key}) AS BIGINT) AS soma_chaves FROM {table}"""
            for table, key, name in _TABLES
        ),
    ),
    "warehouse_sampled": _select(
        _STAR,
        """SELECT * FROM fact WHERE id_mae IN (
  SELECT "CONTADOR" FROM clean ORDER BY md5('42|' || CAST("CONTADOR" AS VARCHAR)) LIMIT 1000)""",
    ),
    "silver_roundtrip": _select(_CLEAN, _SILVER),
    "land_if_absent": _select(
        _RAW,
        """SELECT 'created' AS primeira, 'exists' AS segunda, count(*) AS linhas,
       CAST(sum("CONTADOR") AS BIGINT) AS soma_contador FROM raw""",
    ),
    "report_births_total": _select(_WIDE, "SELECT count(*) AS nascimentos FROM fact"),
    "report_age_band": _select(
        _WIDE,
        f"SELECT {_AGE_BAND}, count(*) AS nascimentos FROM wide GROUP BY 1",
    ),
    "report_mean_age": _select(_WIDE, "SELECT avg(idade) AS idade_media FROM wide"),
    "report_education": _select(_WIDE, _counted("escolaridade")),
    "report_age_children": _select(
        _WIDE,
        """SELECT CAST(idade AS BIGINT) AS idade, count(*) AS nascimentos,
       CAST(sum(qtd_filhovivo) AS BIGINT) AS filhos_vivos,
       CAST(sum(qtd_filhomorto) AS BIGINT) AS filhos_mortos,
       avg(qtd_filhovivo) AS media_filhos_vivos, avg(qtd_filhomorto) AS media_filhos_mortos
FROM wide GROUP BY 1""",
    ),
    "report_occupation": _select(_WIDE, _counted("ocupacao")),
    "report_occupation_top": _select(
        _WIDE, _counted("ocupacao") + " ORDER BY nascimentos DESC, ocupacao LIMIT 10"
    ),
    "report_employment": _select(
        _WIDE,
        """SELECT id_codocupmae NOT IN (SELECT c_custkey FROM customer
                             WHERE c_mktsegment = 'HOUSEHOLD') AS empregada,
       count(*) AS nascimentos
FROM wide GROUP BY 1""",
    ),
    "report_region": _select(_WIDE, _counted("regiao")),
    "report_place_by_region": _select(
        _WIDE,
        f"""SELECT coalesce(regiao, {_UNKNOWN}) AS regiao,
       coalesce(local_nascimento, {_UNKNOWN}) AS local_nascimento, count(*) AS nascimentos
FROM wide GROUP BY 1, 2""",
    ),
    "report_delivery_by_race": _select(
        _WIDE,
        f"""SELECT coalesce(raca_mae, {_UNKNOWN}) AS raca_mae, coalesce(parto, {_UNKNOWN}) AS parto,
       count(*) AS nascimentos
FROM wide GROUP BY 1, 2""",
    ),
    "report_delivery_by_race_table": _select(
        _WIDE,
        f"""SELECT coalesce(raca_mae, {_UNKNOWN}) AS raca_mae,
       count(*) FILTER (parto = 'Vaginal') AS vaginal,
       count(*) FILTER (parto = 'Cesário') AS "cesário",
       count(*) FILTER (parto = 'Ignorado') AS ignorado,
       count(*) FILTER (parto IS NULL) AS desconhecido
FROM wide GROUP BY 1""",
    ),
    "report_delivery_totals": _select(
        _WIDE,
        """SELECT count(*) AS partos, count(*) FILTER (parto = 'Vaginal') AS vaginais,
       count(*) FILTER (parto = 'Cesário') AS cesarios FROM wide""",
    ),
    "report_consultations": _select(_WIDE, _counted("descricao_consultas", "descricao")),
    "report_marital_status": _select(
        _WIDE,
        f"""SELECT coalesce(estado_civil, {_UNKNOWN}) AS estado_civil, count(*) AS nascimentos,
       CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM fact) AS participacao
FROM wide GROUP BY 1""",
    ),
    "report_newborn_race": _select(_WIDE, _counted("raca_nascidos")),
    "report_month_vs_average": _select(
        _WIDE + """,
months AS (
  SELECT CAST(date_trunc('month', id_calendario) AS DATE) AS mes, count(*) AS nascimentos
  FROM fact GROUP BY 1
)""",
        """SELECT mes, nascimentos, mean.media,
       CASE WHEN nascimentos > mean.media THEN 'acima' WHEN nascimentos < mean.media THEN 'abaixo'
            ELSE 'igual' END AS situacao
FROM months, (SELECT avg(nascimentos) AS media FROM months) mean""",
    ),
    "report_state_pareto": _select(
        _WIDE + f""",
states AS ({_counted("estado")})""",
        """SELECT s.estado, s.nascimentos,
       CAST(s.nascimentos AS DOUBLE) / (SELECT count(*) FROM fact) AS participacao,
       CAST((SELECT sum(t.nascimentos) FROM states t
             WHERE t.nascimentos > s.nascimentos
                OR (t.nascimentos = s.nascimentos AND t.estado <= s.estado)) AS DOUBLE)
         / (SELECT count(*) FROM fact) AS acumulado
FROM states s""",
    ),
    "report_filtered": _select(
        _WIDE,
        f"""SELECT coalesce(raca_nascidos, {_UNKNOWN}) AS raca_nascidos, count(*) AS nascimentos
FROM {_CHOSEN} GROUP BY 1""",
    ),
    "report_filtered_profile": _select(
        _WIDE, f"SELECT {_AGE_BAND}, count(*) AS nascimentos FROM {_CHOSEN} GROUP BY 1"
    ),
    "report_filtered_occupations": _select(
        _WIDE,
        f"""SELECT coalesce(ocupacao, {_UNKNOWN}) AS ocupacao, count(*) AS nascimentos
FROM {_CHOSEN} GROUP BY 1""",
    ),
    "report_filtered_health": _select(
        _WIDE,
        f"""SELECT coalesce(raca_mae, {_UNKNOWN}) AS raca_mae, coalesce(parto, {_UNKNOWN}) AS parto,
       count(*) AS nascimentos
FROM {_CHOSEN} GROUP BY 1, 2""",
    ),
    "report_filtered_geography": _select(
        _WIDE + f""",
months AS (
  SELECT CAST(date_trunc('month', id_calendario) AS DATE) AS mes, count(*) AS nascimentos
  FROM {_CHOSEN} GROUP BY 1
)""",
        """SELECT mes, nascimentos, mean.media,
       CASE WHEN nascimentos > mean.media THEN 'acima' WHEN nascimentos < mean.media THEN 'abaixo'
            ELSE 'igual' END AS situacao
FROM months, (SELECT avg(nascimentos) AS media FROM months) mean""",
    ),
    "report_filtered_places": _select(
        _WIDE,
        f"""SELECT coalesce(regiao, {_UNKNOWN}) AS regiao,
       coalesce(local_nascimento, {_UNKNOWN}) AS local_nascimento, count(*) AS nascimentos
FROM {_CHOSEN} GROUP BY 1, 2""",
    ),
    "report_filters_reset": _select(_WIDE, "SELECT count(*) AS nascimentos FROM wide"),
}

ORACLE["warehouse_named_tables"] = ORACLE["warehouse_tables"]


def _pareto(code: str) -> str:
    return f"""
SELECT {code}, nascimentos, CAST(nascimentos AS DOUBLE) / (SELECT count(*) FROM fact) AS participacao,
       CAST(sum(nascimentos) OVER (ORDER BY nascimentos DESC, {code} ROWS UNBOUNDED PRECEDING) AS DOUBLE)
         / (SELECT count(*) FROM fact) AS acumulado
FROM (SELECT {code}, count(*) AS nascimentos FROM wide GROUP BY 1)"""


ORACLE["report_municipality_pareto"] = _select(_WIDE, _pareto("id_codmunnasc"))
ORACLE["report_occupation_pareto"] = _select(_WIDE, _pareto("id_codocupmae"))

# A report from the stored counts is the report.
ORACLE |= {f"cube_{name.removeprefix('report_')}": sql for name, sql in ORACLE.items() if name.startswith("report_")}

for _name, _states in (("states", "estado IN ('AF', 'AS')"), ("unknown_states", "estado = 'EU' OR estado IS NULL")):
    ORACLE[f"report_{_name}_by_month"] = _select(
        _WIDE + f""",
months AS (
  SELECT CAST(date_trunc('month', id_calendario) AS DATE) AS mes, count(*) AS nascimentos
  FROM wide WHERE {_states} GROUP BY 1
)""",
        """SELECT mes, nascimentos, mean.media,
       CASE WHEN nascimentos > mean.media THEN 'acima' WHEN nascimentos < mean.media THEN 'abaixo'
            ELSE 'igual' END AS situacao
FROM months, (SELECT avg(nascimentos) AS media FROM months) mean""",
    )

# Births of 1996 with a number divisible by 7 moved to 2000, if they are still plausible there.
_CORRECTED = _LATER + f""",
first AS (SELECT * FROM ({_select(_births("raw"), "SELECT * FROM clean")})),
second AS (SELECT * FROM ({_select(_births("later"), "SELECT * FROM clean")})),
moved AS (SELECT * FROM second WHERE "CONTADOR" % 7 = 0 AND year("DTNASC") = 2000),
left_alone AS (SELECT * FROM first WHERE "CONTADOR" NOT IN (SELECT "CONTADOR" FROM moved)),
touched AS (
  SELECT year("DTNASC") AS ano FROM moved
  UNION SELECT year("DTNASC") FROM first WHERE "CONTADOR" IN (SELECT "CONTADOR" FROM moved)
),
loaded_second AS (
  SELECT DISTINCT year("DTNASC") AS ano FROM second
),
after AS (
  SELECT * FROM left_alone UNION ALL SELECT * FROM moved UNION ALL SELECT * FROM second
)"""

_LOADED = """
SELECT "CONTADOR" AS id_mae, year("DTNASC") AS ano, "DTNASC" AS id_calendario,
       "DTNASCMAE" AS dtnascmae, "ESCMAE" AS id_escmae, """

ORACLE["append_corrections"] = _select(
    _CORRECTED,
    _LOADED
    + """CAST(CASE WHEN year("DTNASC") IN (SELECT ano FROM touched) THEN 3
            WHEN year("DTNASC") IN (SELECT ano FROM loaded_second) THEN 2 ELSE 1 END AS BIGINT) AS carga
FROM after""",
)
ORACLE["cube_after_corrections"] = _select(
    _CORRECTED, 'SELECT year("DTNASC") AS ano, count(*) AS nascimentos FROM after GROUP BY 1'
)
ORACLE["append_withdrawals"] = _select(
    _CLEAN + """,
gone AS (SELECT * FROM clean WHERE year("DTNASC") IN (1997, 1998) AND "CONTADOR" % 3 = 0)""",
    _LOADED
    + """CAST(CASE WHEN year("DTNASC") IN (SELECT year("DTNASC") FROM gone) THEN 2 ELSE 1 END AS BIGINT) AS carga
FROM clean WHERE "CONTADOR" NOT IN (SELECT "CONTADOR" FROM gone)""",
)

_FAILED = [("antes", 1), ("depois da falha", 1), ("depois da repetição", 2)]
ORACLE["warehouse_failed_run"] = _select(
    f"""{_LATER},
first AS (SELECT * FROM ({_select(_births("raw"), "SELECT * FROM clean")})),
second AS (SELECT * FROM ({_select(_births("later"), "SELECT * FROM clean")})),
loads AS (SELECT 1 AS load, * FROM first UNION ALL SELECT 2, * FROM second),
titles AS (
  SELECT DISTINCT load, "CODOCUPMAE" AS code FROM loads
  WHERE "CODOCUPMAE" IN (SELECT c_custkey FROM customer)
)""",
    "\nUNION ALL\n".join(
        f"""SELECT '{moment}' AS momento, '{table}' AS tabela, count(*) AS linhas,
       {f'CAST(sum({key}) AS BIGINT)' if key else 'NULL::BIGINT'} AS soma_chaves
FROM {source} WHERE load <= {last}"""
        for moment, last in _FAILED
        for table, key, source in (
            ("fatos_nascidos", '"CONTADOR"', "loads"),
            ("dim_mae", '"CONTADOR"', "loads"),
            ("dim_profissao", "code", "titles"),
            ("cubo", None, "loads"),
        )
    ),
)

_RENAMED = """CASE WHEN o.code % 4 = 0 THEN o.title || ' *' ELSE o.title END"""
ORACLE["label_as_of"] = _select(
    f"{_CLEAN},{_REFERENCE}",
    "\nUNION ALL\n".join(
        f"""SELECT '{view}' AS visao, {label} AS ocupacao, count(*) AS nascimentos
FROM clean b LEFT JOIN occupation o ON o.code = b."CODOCUPMAE" GROUP BY 2"""
        for view, label in (
            ("nascimento", f"""CASE WHEN b."DTNASC" < DATE '1998-07-01' THEN o.title ELSE {_RENAMED} END"""),
            ("antes", "o.title"),
            ("depois", _RENAMED),
            ("atual", _RENAMED),
        )
    ),
)
