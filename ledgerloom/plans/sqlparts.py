"""The domain frames as SQL, for the check of the Spark results."""

RUN_DATE = "DATE '1998-06-15'"
RUN_TS = "TIMESTAMP '1998-06-15 09:00:00'"
M = "DECIMAL(15,2)"
T = "DECIMAL(18,2)"


def num(k: str) -> str:
    return f"(CASE WHEN length(CAST({k} AS VARCHAR)) < 7 THEN lpad(CAST({k} AS VARCHAR), 7, '0') ELSE CAST({k} AS VARCHAR) END)"


def code(c: str) -> str:
    return f"(CAST({c} % 9 + 1 AS VARCHAR) || '-' || lpad(CAST({c} % 100 AS VARCHAR), 2, '0') || '-' || CAST({c} AS VARCHAR))"


def pick(values: list[str], index: str) -> str:
    return "([" + ", ".join(f"'{v}'" for v in values) + f"][CAST({index} AS BIGINT) + 1])"


def docnum(k: str) -> str:
    kind = pick(["IV", "OL", "CM", "SR", "SC"], f"{k} % 5")
    return (
        f"({kind} || CASE WHEN {k} % 5 >= 3 THEN {num(f'({k} - 3)')} ELSE {num(k)} END"
        f" || CASE WHEN {k} % 5 >= 3 AND {k} % 2 = 0 THEN '-1' ELSE '' END)"
    )


LINE_ORDER = (
    "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
)

ARTRN = f"""artrn AS (
  SELECT {docnum('o_orderkey')} AS docnum, CAST(o_orderdate AS DATE) AS docdat,
         CASE WHEN o_orderkey % 5 >= 3 AND o_orderkey % 3 <> 0
              THEN CASE WHEN o_orderkey % 5 = 3 THEN 'IV' ELSE 'OL' END || {num('(o_orderkey - 3)')} END AS sonum,
         {code('o_custkey')} AS cuscod,
         CAST(o_totalprice AS {M}) AS amount,
         CAST(o_orderkey % 7 AS {M}) AS disc,
         CAST(CAST(o_totalprice AS {M}) - o_orderkey % 7 AS {M}) AS total,
         CAST(CAST(o_totalprice AS {M}) - o_orderkey % 7 AS {M}) AS netval,
         CAST(CASE o_orderstatus WHEN 'O' THEN CAST(o_totalprice AS {M}) - o_orderkey % 7 WHEN 'P' THEN 100 ELSE 0 END AS {M}) AS remamt,
         CAST((o_custkey % 4) * 30 AS INTEGER) AS paytrm,
         o_orderstatus AS dlvby, o_orderstatus AS docstat,
         CASE WHEN o_orderkey % 11 = 0 THEN '~' WHEN o_orderkey % 13 = 0 THEN ''
              ELSE 'B' || CAST(o_orderkey // 4 AS VARCHAR) END AS bilnum,
         CAST(CAST(o_orderdate AS DATE) + CAST((o_custkey % 4) * 30 AS INTEGER) AS DATE) AS duedat,
         o_orderkey AS line_no
  FROM orders)"""

HEADERS = f"""{ARTRN}, headers AS (
  SELECT docnum AS doc_number, docdat AS doc_date, cuscod AS customer_code, docstat AS doc_stat,
         * EXCLUDE (docnum, docdat, cuscod, docstat) FROM artrn)"""

AR_DOCS = f"""ardocs AS (
  SELECT {pick(['IV', 'OL', 'CM', 'SR', 'AI', 'RE'], 'o_orderkey % 6')} || {num('o_orderkey')} AS docnum,
         CAST(o_orderdate AS DATE) AS docdat,
         CAST(CAST(o_orderdate AS DATE) + CAST((o_custkey % 4) * 30 AS INTEGER) AS DATE) AS duedat,
         {code('o_custkey')} AS cuscod, CAST(o_totalprice AS {M}) AS netval,
         CAST(CASE WHEN o_orderstatus = 'O' THEN CAST(o_totalprice AS {M}) ELSE 0 END AS {M}) AS remamt
  FROM orders)"""

RECEIPTS = f"""receipts AS (
  SELECT {pick(['RE', 'RC', 'RD', 'RM', 'AI', 'AC', 'IV'], 'o_orderkey % 7')} || {num('o_orderkey')} AS docnum,
         CAST(CAST(o_orderdate AS DATE) + 10000 AS DATE) AS docdat, {code('o_custkey')} AS cuscod
  FROM orders)"""

PAYABLES = f"""payables AS (
  SELECT {pick(['HI', 'HP', 'PS', 'PN', 'XX'], 'o_orderkey % 5')} || {num('o_orderkey')} AS docnum,
         CAST(CAST(o_orderdate AS DATE) + 10000 AS DATE) AS docdat, 'S' || CAST(o_custkey % 100 AS VARCHAR) AS supcod
  FROM orders)"""

BANK = f"""bank AS (
  SELECT CASE WHEN event_id % 2 = 0 THEN {pick(['RE', 'RC', 'RD', 'RM', 'AI', 'AC', 'IV'], 'event_id % 7')}
              ELSE {pick(['HI', 'HP', 'PS', 'PN', 'XX'], 'event_id % 5')} END || {num('event_id')} AS voucher,
         {pick(['QR', 'BT', '*', 'C'], 'event_id % 4')} || CAST(event_id AS VARCHAR) AS chqnum,
         CAST(ts AS DATE) AS trndat,
         CASE WHEN event_id % 10 <> 9 THEN 'ACC' || CAST(user_id % 12 AS VARCHAR) END AS bnkacc,
         CASE WHEN event_id % 3 <> 0 THEN CAST(CAST(ts AS DATE) + 1 AS DATE) END AS payindat,
         CAST(value AS {M}) AS netamt,
         CAST(CAST(ts AS DATE) + CAST(event_id % 5 AS INTEGER) AS DATE) AS chqdat,
         CASE WHEN event_id % 6 = 0 THEN '  ' ELSE ' ' || event_type || ' ' END AS remark,
         CASE WHEN event_id % 2 = 0 THEN 'Y' END AS cmplapp,
         CASE (event_id // 4) % 4 WHEN 0 THEN 'BT' WHEN 1 THEN 'BX' WHEN 3 THEN 'QQ' END AS bktrntyp,
         CASE WHEN event_id % 8 <> 1 THEN {code('user_id')} END AS cuscod
  FROM events)"""

CUSTOMERS = f"""customers AS (
  SELECT {code('c_custkey')} AS cuscod, c_name AS cusnam, CAST(c_acctbal AS {M}) AS crline,
         CAST((c_custkey % 4) * 30 AS INTEGER) AS paytrm FROM customer)"""

AREAS = f"""areas AS (
  SELECT 'AREA' || CAST(n_nationkey AS VARCHAR) AS sale_area, CAST(n_nationkey AS VARCHAR) AS cuscod_startwith
    FROM nation WHERE n_nationkey BETWEEN 1 AND 7
  UNION ALL
  SELECT 'ZONE' || CAST(n_nationkey AS VARCHAR), CAST(n_nationkey % 9 + 1 AS VARCHAR) || '-' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') FROM nation
  UNION ALL
  SELECT 'SHOP' || CAST(s_suppkey AS VARCHAR), {code('s_suppkey')} FROM supplier)"""


def details(modulus: int | None = None) -> str:
    part = f"(l_partkey % {modulus})" if modulus else "l_partkey"
    return f"""details AS (
  SELECT {docnum('l_orderkey')} AS docnum, CAST(l_shipdate AS DATE) AS docdat, CAST(l_linenumber AS INTEGER) AS seqnum,
         'SKU-' || CAST({part} AS VARCHAR) AS stkcod, 'item ' || CAST({part} AS VARCHAR) AS stkdes,
         l_linestatus AS people, l_returnflag AS flag, CAST(l_quantity AS {M}) AS trnqty,
         CAST(CASE WHEN {part} % 7 = 3 THEN 0 ELSE {part} % 5 + 10 END AS {M}) AS unitpr, CAST(CAST(l_discount AS {M}) AS VARCHAR) AS disc,
         CAST(l_extendedprice AS {M}) AS trnval, {LINE_ORDER}
  FROM lineitem)"""


MOVES = f"""moves AS (
  SELECT {pick(['IV', 'OL', 'PD', 'HI', 'RR', 'LL', 'JU', 'TK', 'RI'], 'l_suppkey % 9')} || {num('l_orderkey')} AS docnum,
         CAST(l_shipdate AS DATE) AS docdat, 'SKU-' || CAST(l_partkey AS VARCHAR) AS stkcod,
         CAST(CAST(l_quantity AS {M}) * CASE WHEN l_suppkey % 9 IN (6, 7) AND l_linestatus = 'O' THEN -1 ELSE 1 END AS {M}) AS trnqty,
         CAST(CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_extendedprice END AS {M}) AS unitpr,
         CAST(l_extendedprice AS {M}) AS trnval, CAST(l_linenumber % 2 AS VARCHAR) AS posopr,
         'STCRD' || CAST(year(l_shipdate) AS VARCHAR) || '.DBF' AS source_file, CAST(year(l_shipdate) AS INTEGER) AS file_no, {LINE_ORDER}
  FROM lineitem)"""

CLASSED = f"""{MOVES}, classed AS (
  SELECT m.*, CASE
      WHEN k IN ('IV','OL','OU','PD','OC','OW','OO') THEN per
      WHEN k IN ('HI','RI','RR','HP','PI','JI','LL') THEN 'bought_in'
      WHEN k IN ('JU','TK') AND trnqty > 0 THEN 'bought_in'
      WHEN k IN ('JU','TK') THEN per END AS period,
    CAST(CASE WHEN k IN ('JU','TK') THEN abs(trnqty) ELSE trnqty END AS {M}) AS class_qty
  FROM (SELECT *, left(docnum, 2) AS k,
          CASE WHEN docdat BETWEEN DATE '1998-06-01' AND DATE '1998-06-30' THEN 'this_month'
               WHEN docdat BETWEEN DATE '1998-05-01' AND DATE '1998-05-31' THEN 'last_month' END AS per
        FROM moves) m)"""

MASTER = f"""master AS (
  SELECT *, CAST(totbal * unitpr AS {M}) AS totval FROM (
    SELECT 'SKU-' || CAST(p_partkey AS VARCHAR) AS stkcod, CAST(p_size AS {M}) AS totbal,
           CAST(CASE WHEN p_partkey % 3 <> 0 THEN p_retailprice ELSE 0 END AS {M}) AS unitpr,
           CASE WHEN p_partkey % 2 = 0 THEN CAST(DATE '1996-01-01' + CAST(p_partkey % 1000 AS INTEGER) AS DATE) END AS lpurdat,
           CAST(p_retailprice AS {M}) AS lpurpr
    FROM part))"""

PRODUCTS = f"""products AS (
  SELECT 'SKU-' || CAST(p_partkey AS VARCHAR) AS stkcod, p_name AS stkdes, '885' || CAST(p_partkey AS VARCHAR) AS barcod,
         CAST(p_partkey % 30 AS VARCHAR) AS acccod, CAST(p_size % 28 AS VARCHAR) AS stkgrp, CAST(p_partkey % 6 AS VARCHAR) AS qucod,
         CAST(CASE WHEN p_partkey % 4 <> 0 THEN p_retailprice END AS {M}) AS unitpr
  FROM part)"""

DIMENSION = f"""{PRODUCTS}, dimension AS (
  SELECT p.stkcod, p.stkdes, p.barcod AS barcode, 'ACC ' || a.n_name AS category, g.n_name AS "group", u.r_name AS unit,
         'E' || CAST(f.s_nationkey AS VARCHAR) AS owner_emp_id
  FROM products p
  LEFT JOIN nation a ON p.acccod = CAST(a.n_nationkey AS VARCHAR)
  LEFT JOIN nation g ON p.stkgrp = CAST(g.n_nationkey AS VARCHAR)
  LEFT JOIN region u ON p.qucod = CAST(u.r_regionkey AS VARCHAR)
  LEFT JOIN supplier f ON p.stkcod = 'SKU-' || CAST(f.s_suppkey AS VARCHAR)
  WHERE g.n_name IS NOT NULL AND g.n_name NOT IN ('NATION_3', 'NATION_7'))"""

WHITE_LIST = "white_list AS (SELECT 'SKU-' || CAST(s_suppkey AS VARCHAR) AS stkcod FROM supplier)"

REMARKS = f"""remarks AS (
  SELECT {docnum('l_orderkey')} AS docnum, l_linenumber AS seqnum, {LINE_ORDER},
         CASE WHEN l_linenumber = 7 THEN '' ELSE 'part ' || CAST(l_partkey AS VARCHAR) || '  ,' ||
           CASE WHEN l_orderkey % 4 = 0 AND l_linenumber = 3 THEN '//24010' || CAST(l_orderkey AS VARCHAR) || ')'
                WHEN l_orderkey % 4 = 1 THEN '// ' || CAST(l_linenumber AS VARCHAR) || ')' ELSE '' END
           || '   ok ' || l_returnflag END AS remark
  FROM lineitem WHERE l_orderkey % 5 < 3)"""
