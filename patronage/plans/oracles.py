"""The same queries in SQL, for an independent engine over the same tables.

Written from the definitions, not from the DataFrame plans. Shared parts are
common table expressions; each query names the ones it needs.
"""

from __future__ import annotations

from ..operators.loyalty import OBSERVABLE
from . import settings as s

# name -> (names it builds on, body)
PARTS: dict[str, tuple[tuple[str, ...], str]] = {
    "conv": (
        (),
        """SELECT o_orderkey, o_custkey, 1 + o_custkey % 3 AS idsite, lower(to_hex(o_custkey)) AS "user",
        o_orderdate + to_hours(o_orderkey * 7 % 24) AS server_time,
        epoch_ms(o_orderdate) + o_orderkey * 7 % 24 * 3600000 AS "timestamp",
        CAST(o_orderkey AS VARCHAR) AS idorder,
        CAST(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS INTEGER) AS idgoal,
        o_totalprice AS revenue_subtotal,
        ((o_custkey * 7919) % 18000) / 100.0::DOUBLE - 90 AS lat,
        ((o_custkey * 104729) % 36000) / 100.0::DOUBLE - 180 AS lon
        FROM orders""",
    ),
    "item": (
        (),
        """SELECT 1 + o_custkey % 3 AS idsite, lower(to_hex(o_custkey)) AS "user", o_custkey,
        o_orderdate + to_hours(o_orderkey * 7 % 24) + to_seconds(l_linenumber) AS server_time,
        epoch_ms(o_orderdate) + o_orderkey * 7 % 24 * 3600000 + l_linenumber * 1000::BIGINT AS "timestamp",
        CAST(o_orderkey AS VARCHAR) AS idorder, l_partkey AS idaction_sku,
        CAST(replace(p_brand, 'Brand#', '') AS BIGINT) AS brand,
        l_extendedprice AS price, l_quantity AS quantity, l_returnflag = 'R' AS deleted
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    ),
    "visit": (
        (),
        """SELECT 1 + user_id % 3 AS idsite, lower(to_hex(user_id)) AS "user", user_id, ts AS server_time,
        epoch_us(ts) // 1000 AS "timestamp", user_id * 100 + day(ts) AS idvisit,
        CAST(json_extract_string(props, '$.k') AS BIGINT) AS idaction_url, event_type
        FROM events""",
    ),
    "view": (
        ("visit",),
        """SELECT CAST(idsite AS VARCHAR) AS site, "user" AS visitor,
        '/' || event_type || '/' || idaction_url AS pageurl, server_time AS ts FROM visit""",
    ),
    "kept": (("item",), "SELECT * FROM item WHERE NOT deleted"),
    "basket": (
        ("kept",),
        """SELECT idsite, "user", idorder, 0::INTEGER AS segment, min("timestamp") AS "timestamp",
        string_agg(CAST(idaction_sku AS VARCHAR), ' ' ORDER BY "timestamp", idaction_sku) AS items
        FROM kept GROUP BY idsite, "user", idorder""",
    ),
    # preferences
    "line": (
        ("kept",),
        """SELECT DISTINCT idsite || '|' || "user" AS cid, idorder, idaction_sku AS item FROM kept""",
    ),
    "brandline": (
        ("kept",),
        """SELECT DISTINCT idsite || '|' || "user" AS cid, idorder, brand AS item FROM kept""",
    ),
    "totals": (("line",), "SELECT cid, count(DISTINCT idorder) AS total FROM line GROUP BY cid"),
    "support": (("line",), "SELECT cid, item, count(*) AS supp FROM line GROUP BY cid, item"),
    "pref": (
        ("support", "totals"),
        "SELECT cid, item, ln(1.0::DOUBLE + supp::DOUBLE / total::DOUBLE) AS pref FROM support JOIN totals USING (cid)",
    ),
    "mpref": (("pref",), "SELECT item, max(pref) AS mpref FROM pref GROUP BY item"),
    "score": (
        ("pref", "mpref"),
        """SELECT cid AS "user", CAST(item AS VARCHAR) AS product,
        CAST(floor(5.0::DOUBLE * (pref / mpref) + 0.5::DOUBLE) AS INTEGER) AS score
        FROM pref JOIN mpref USING (item)""",
    ),
    "bounded": (
        ("score",),
        """SELECT * FROM score WHERE "user" IN
        (SELECT "user" FROM score GROUP BY 1 HAVING count(*) >= 10 AND count(*) < 20)""",
    ),
    "selected": (("kept",), """SELECT DISTINCT idsite || '|' || "user" AS cid FROM kept WHERE o_custkey % 100 = 0"""),
    # states
    "tx": (
        ("conv",),
        """SELECT idsite, "user", idorder, "timestamp", revenue_subtotal FROM conv WHERE idgoal = 0""",
    ),
    "lagged": (
        ("tx",),
        """SELECT *, "timestamp" - lag("timestamp") OVER w AS gap, lag(revenue_subtotal) OVER w AS pr
        FROM tx WINDOW w AS (PARTITION BY idsite, "user" ORDER BY "timestamp", idorder)""",
    ),
    "st": (
        ("lagged",),
        """SELECT *, t || a AS state, t || translate(a, 'LEG', 'LSM') AS obs FROM (SELECT *, revenue_subtotal / pr AS ratio,
        CASE WHEN gap / 86400000.0::DOUBLE < 90 THEN 'S' WHEN gap / 86400000.0::DOUBLE < 240 THEN 'M' ELSE 'L' END AS t,
        CASE WHEN revenue_subtotal / pr < 0.9::DOUBLE THEN 'L'
             WHEN revenue_subtotal / pr <= 1.1::DOUBLE THEN 'E' ELSE 'G' END AS a
        FROM lagged WHERE gap IS NOT NULL)""",
    ),
    "tc": (
        ("st",),
        """SELECT idsite, "user", state, next, count(*) AS n FROM (SELECT idsite, "user", state,
        lead(state) OVER (PARTITION BY idsite, "user" ORDER BY "timestamp", idorder) AS next FROM st)
        WHERE next IS NOT NULL GROUP BY ALL""",
    ),
    "own": (
        ("tc",),
        """SELECT * FROM (SELECT idsite, "user", state, next, n / sum(n) OVER (PARTITION BY idsite, "user", state) AS p,
        row_number() OVER (PARTITION BY idsite, "user", state ORDER BY n DESC, next) AS r FROM tc) WHERE r = 1""",
    ),
    "bysite": (
        ("tc",),
        """SELECT * FROM (SELECT idsite, state, next, n / sum(n) OVER (PARTITION BY idsite, state) AS p,
        row_number() OVER (PARTITION BY idsite, state ORDER BY n DESC, next) AS r
        FROM (SELECT idsite, state, next, sum(n) AS n FROM tc GROUP BY ALL)) WHERE r = 1""",
    ),
    "common": (
        ("st",),
        """SELECT * FROM (SELECT idsite, state AS next, n / sum(n) OVER (PARTITION BY idsite) AS p,
        row_number() OVER (PARTITION BY idsite ORDER BY n DESC, state) AS r
        FROM (SELECT idsite, state, count(*) AS n FROM st GROUP BY ALL)) WHERE r = 1""",
    ),
    "ahead": (
        ("tx", "st", "own", "bysite", "common"),
        """SELECT c.idsite, c."user", l.state,
        CASE WHEN l.state IS NULL THEN k.next ELSE coalesce(o.next, b.next) END AS next,
        CASE WHEN l.state IS NULL THEN k.p ELSE coalesce(o.p, b.p) END AS prob,
        CASE WHEN l.state IS NULL THEN 'start' WHEN o.next IS NOT NULL THEN 'own'
             WHEN b.next IS NOT NULL THEN 'site' END AS basis
        FROM (SELECT DISTINCT idsite, "user" FROM tx) c
        LEFT JOIN (SELECT idsite, "user", state FROM st QUALIFY row_number() OVER
          (PARTITION BY idsite, "user" ORDER BY "timestamp" DESC, idorder DESC) = 1) l USING (idsite, "user")
        LEFT JOIN own o ON o.idsite = c.idsite AND o."user" = c."user" AND o.state = l.state
        LEFT JOIN bysite b ON b.idsite = c.idsite AND b.state = l.state
        LEFT JOIN common k ON k.idsite = c.idsite""",
    ),
    # rules
    "wide": (
        ("kept", "conv"),
        """SELECT DISTINCT idsite, "user", idorder, item FROM (
        SELECT idsite, "user", idorder, unnest(['buys=' || brand,
          'daytime=' || CASE WHEN hour(server_time) < 6 THEN 'night' WHEN hour(server_time) < 12 THEN 'morning'
            WHEN hour(server_time) < 18 THEN 'afternoon' ELSE 'evening' END,
          'quantity=' || CASE WHEN quantity < 17 THEN 'low' WHEN quantity < 34 THEN 'mid' ELSE 'high' END]) AS item
        FROM kept
        UNION ALL
        SELECT idsite, "user", idorder, 'location=' || n_name FROM conv
        JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
        WHERE idorder IN (SELECT idorder FROM kept))""",
    ),
    # sequences
    "placed": (
        ("kept",),
        """SELECT idsite, "user", idorder, row_number() OVER (PARTITION BY idsite, "user"
        ORDER BY min("timestamp"), idorder) - 1 AS pos FROM kept GROUP BY idsite, "user", idorder""",
    ),
    "seq": (
        ("kept", "placed"),
        """SELECT DISTINCT k.idsite || '|' || k."user" AS cid, pos, idaction_sku AS item
        FROM kept k JOIN placed p USING (idsite, "user", idorder)""",
    ),
    "bseq": (
        ("kept", "placed"),
        """SELECT DISTINCT k.idsite || '|' || k."user" AS cid, pos, brand AS item
        FROM kept k JOIN placed p USING (idsite, "user", idorder)""",
    ),
    "grp": (
        ("seq",),
        """SELECT cid, min(cid) OVER (PARTITION BY h) AS head, count(*) OVER (PARTITION BY h) AS copies
        FROM (SELECT cid, string_agg(pos || ':' || item, ',' ORDER BY pos, item) AS h FROM seq GROUP BY cid)""",
    ),
    "prof": (
        ("seq",),
        """SELECT cid, pos, item, count(*) OVER (PARTITION BY cid, pos) AS n,
        max(pos) OVER (PARTITION BY cid) + 1 AS len FROM seq""",
    ),
    "sim": (
        ("prof",),
        """SELECT a, b, round(sum(o::DOUBLE / (na + nb - o)) / greatest(any_value(la), any_value(lb)), 9) AS similarity,
        FROM (SELECT x.cid AS a, y.cid AS b, x.pos, count(*) AS o, any_value(x.n) AS na, any_value(y.n) AS nb,
          any_value(x.len) AS la, any_value(y.len) AS lb
          FROM prof x JOIN prof y ON x.pos = y.pos AND x.item = y.item AND x.cid <> y.cid
          GROUP BY x.cid, y.cid, x.pos) GROUP BY a, b""",
    ),
    # geo
    "center": (
        (),
        "SELECT * FROM (VALUES "
        + ", ".join(f"({i}::INTEGER, {a}::DOUBLE, {b}::DOUBLE)" for i, (a, b) in enumerate(s.CENTERS))
        + ") AS t(cluster, clat, clon)",
    ),
    "near": (
        ("conv", "center"),
        """SELECT cluster, clat, clon, lat, lon FROM conv, center QUALIFY row_number() OVER
        (PARTITION BY o_orderkey ORDER BY (lat - clat) * (lat - clat) + (lon - clon) * (lon - clon), cluster) = 1""",
    ),
}


def _image(suffix: str, width: int, height: int) -> dict[str, tuple[tuple[str, ...], str]]:
    """Points as pixels (pix), occupied pixels (spot), all pixels (cell) and their heat (heat, near) on an image."""

    def pixel(share: str, size: int) -> str:
        return f"CAST(trunc({size}::DOUBLE * (0.5::DOUBLE {share}::DOUBLE)) AS INTEGER)"

    return {
        f"pix{suffix}": (
            ("near",),
            f"""SELECT cluster, {pixel('+ clon / 360.0', width)} AS cx, {pixel('- clat / 180.0', height)} AS cy,
        {pixel('+ lon / 360.0', width)} AS x, {pixel('- lat / 180.0', height)} AS y FROM near""",
        ),
        f"spot{suffix}": ((f"pix{suffix}",), f"SELECT x, y, count(*) AS c FROM pix{suffix} GROUP BY x, y"),
        f"cell{suffix}": (
            (),
            f"""SELECT CAST(a.x AS INTEGER) AS x, CAST(b.y AS INTEGER) AS y
        FROM range(0, {width}) AS a(x), range(0, {height}) AS b(y)""",
        ),
        f"heat{suffix}": (
            (f"spot{suffix}", f"cell{suffix}"),
            f"""SELECT g.x, g.y, round(coalesce(sum(CASE WHEN p.c IS NULL THEN 0.0::DOUBLE
          WHEN p.x = g.x AND p.y = g.y THEN p.c::DOUBLE
          ELSE p.c::DOUBLE / ((p.x - g.x) * (p.x - g.x) + (p.y - g.y) * (p.y - g.y))::DOUBLE END), 0.0::DOUBLE), 6) AS heat
        FROM cell{suffix} g LEFT JOIN spot{suffix} p ON abs(p.x - g.x) < {width // 5} AND abs(p.y - g.y) < {width // 5}
        GROUP BY g.x, g.y""",
        ),
        f"points{suffix}": (
            (f"spot{suffix}", f"cell{suffix}"),
            f"""SELECT g.x, g.y, coalesce(h.heat, 0.0::DOUBLE) AS heat FROM cell{suffix} g LEFT JOIN (
        SELECT a.x, a.y, round(sum(CASE WHEN a.x = b.x AND a.y = b.y THEN b.c::DOUBLE ELSE
          b.c::DOUBLE / ((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y))::DOUBLE END), 6) AS heat
        FROM spot{suffix} a, spot{suffix} b GROUP BY a.x, a.y) h ON h.x = g.x AND h.y = g.y""",
        ),
    }


def _factors(suffix: str, lines: str) -> dict[str, tuple[tuple[str, ...], str]]:
    """Terms of users and products (term), factors by rule (factor) and all ratings (rated)."""
    return {
        f"term{suffix}": (
            (lines,),
            f"""SELECT 'user' AS kind, cid AS term FROM {lines} GROUP BY cid
        UNION ALL SELECT 'product', CAST(item AS VARCHAR) FROM {lines} GROUP BY item""",
        ),
        f"factor{suffix}": (
            (f"term{suffix}",),
            f"""SELECT kind, term, idx,
        list_transform(range(1, {s.RANK + 1}),
          lambda r: ((idx * r + r * r + CASE WHEN kind = 'user' THEN 3 ELSE 5 END) % 17) / 8.0::DOUBLE) AS f
        FROM (SELECT kind, term, row_number() OVER (PARTITION BY kind
              ORDER BY substr(md5(term), 1, 3), term) - 1 AS idx FROM term{suffix})""",
        ),
        f"rated{suffix}": (
            (f"factor{suffix}",),
            f"""SELECT u.term AS "user", p.term AS product, list_dot_product(u.f, p.f) AS rating
        FROM factor{suffix} u, factor{suffix} p WHERE u.kind = 'user' AND p.kind = 'product'""",
        ),
    }


PARTS |= _factors("", "brandline") | _factors("_part", "line")
PARTS |= _image("", s.WIDTH, s.HEIGHT) | _image("_fine", s.FINE_WIDTH, s.FINE_HEIGHT)


def _with(names: tuple[str, ...], recursive: str = "") -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in PARTS[name][0]:
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    body = ", ".join(f"{n} AS ({PARTS[n][1]})" for n in ordered)
    return f"WITH {recursive} {body}"


def _sql(names: str, select: str) -> str:
    return f"{_with(tuple(names.split()))} {select}" if names else select


def _window(column: str, start: str, end: str) -> str:
    return f"{column} > TIMESTAMP '{start}' AND {column} < TIMESTAMP '{end}'"


VISITOR = "lpad(lower(to_hex({})), 16, '0') AS idvisitor"


def _itemsets(source: str, keys: str, parts: str, support: float, longest: int) -> str:
    """Common table expressions: u (unique lines), few (frequent items), sets (itemsets)."""
    steps = [
        f"u AS (SELECT DISTINCT {keys} AS k, item FROM {source})",
        f"need AS (SELECT CAST(ceil({support}::DOUBLE * count(DISTINCT k) - 1e-9) AS BIGINT) AS m FROM u)",
        "few AS (SELECT item FROM u GROUP BY item HAVING count(*) >= (SELECT m FROM need))",
        "f1 AS (SELECT k, [item] AS items, item AS last FROM u WHERE item IN (SELECT item FROM few))",
    ]
    for n in range(2, longest + 1):
        steps.append(
            f"f{n} AS (SELECT a.k, list_append(a.items, b.item) AS items, b.item AS last "
            f"FROM f{n - 1} a JOIN u b ON a.k = b.k AND b.item > a.last "
            f"WHERE b.item IN (SELECT item FROM few) AND a.items IN "
            f"(SELECT items FROM f{n - 1} GROUP BY items HAVING count(*) >= (SELECT m FROM need)))"
        )
    union = " UNION ALL ".join(f"SELECT items FROM f{n}" for n in range(1, longest + 1))
    steps.append(
        f"sets AS (SELECT items, count(*) AS support FROM ({union}) GROUP BY items "
        "HAVING count(*) >= (SELECT m FROM need))"
    )
    steps.append(
        "rule AS (SELECT list_filter(z.items, lambda i: i <> z.c) AS antecedent, z.c AS consequent, z.support, "
        "z.support / b.support AS confidence FROM (SELECT items, support, unnest(items) AS c FROM sets "
        "WHERE len(items) > 1) z JOIN sets b ON b.items = list_filter(z.items, lambda i: i <> z.c))"
    )
    return f"{_with(tuple(parts.split()))}, " + ", ".join(steps)


def _patterns(longest: int) -> str:
    """Frequent sequences, grown item by item from frequent ones; each level keeps where a customer's pattern ends."""
    steps = [
        f"need AS (SELECT CAST(ceil({s.SEQUENCE_SUPPORT}::DOUBLE * count(DISTINCT cid) - 1e-9) AS BIGINT) AS m FROM bseq)",
        "e1 AS (SELECT CAST(item AS VARCHAR) AS pattern, cid, pos, item AS last FROM bseq)",
    ]
    for n in range(1, longest + 1):
        steps.append(
            f"k{n} AS (SELECT pattern, count(DISTINCT cid) AS support FROM e{n} GROUP BY pattern "
            "HAVING count(DISTINCT cid) >= (SELECT m FROM need))"
        )
        steps.append(
            f"e{n + 1} AS (SELECT DISTINCT a.pattern || CASE WHEN b.pos > a.pos THEN ' > ' ELSE ' ' END || b.item AS pattern, "
            f"a.cid, b.pos, b.item AS last FROM e{n} a JOIN bseq b ON a.cid = b.cid AND (b.pos > a.pos OR b.pos = a.pos AND b.item > a.last) "
            f"WHERE a.pattern IN (SELECT pattern FROM k{n}) AND CAST(b.item AS VARCHAR) IN (SELECT pattern FROM k1))"
        )
    union = " UNION ALL ".join(f"SELECT pattern, support FROM k{n}" for n in range(1, longest + 1))
    return f"{_with(('bseq',))}, " + ", ".join(steps) + f" {union}"


def _top_rules(ctes: str, confidence: float) -> str:
    return (
        f"{ctes} SELECT array_to_string(antecedent, ' ') AS antecedent, "
        "CAST(consequent AS VARCHAR) AS consequent, support, round(confidence, 9) AS confidence "
        f"FROM rule WHERE confidence >= {confidence}::DOUBLE "
        f"ORDER BY rule.support DESC, rule.confidence DESC, rule.antecedent, rule.consequent LIMIT {s.TOP_RULES}"
    )


def _viterbi(final: str) -> str:
    def e(x: float) -> str:
        return f"{s.log(x)!r}e0::DOUBLE"

    emit = ["[" + ", ".join(e(p) for p in row) + "]" for row in s.MODEL.emit]
    start = ", ".join(f"{e(p)} + {emit[j]}[o.code] AS v{j}" for j, p in enumerate(s.MODEL.start))
    names = "LNH"
    first = ", ".join(f"'{h}' AS p{j}" for j, h in enumerate(names))
    arrive = ", ".join(
        f"v.v{i} + {e(s.MODEL.step[i][j])} AS a{i}{j}" for i in range(3) for j in range(3)
    )
    best = ", ".join(
        f"greatest(a0{j}, a1{j}, a2{j}) + {emit[j]}[code] AS v{j}" for j in range(3)
    )
    path = ", ".join(
        f"CASE WHEN a0{j} = greatest(a0{j}, a1{j}, a2{j}) THEN p0 WHEN a1{j} = greatest(a0{j}, a1{j}, a2{j}) "
        f"THEN p1 ELSE p2 END || ' {h}' AS p{j}"
        for j, h in enumerate(names)
    )
    codes = "[" + ", ".join(f"'{o}'" for o in OBSERVABLE) + "]"
    return (
        f"{_with(('st',), 'RECURSIVE')}, "
        'o AS MATERIALIZED (SELECT idsite, "user", row_number() OVER w AS k, '
        f"list_position({codes}, obs) AS code, count(*) OVER (PARTITION BY idsite, \"user\") AS n FROM st "
        'WINDOW w AS (PARTITION BY idsite, "user" ORDER BY "timestamp", idorder)), '
        f'v AS (SELECT o.idsite, o."user", o.k, o.n, {start}, {first} FROM o WHERE k = 1 UNION ALL '
        f'SELECT idsite, "user", k, n, {best}, {path} FROM (SELECT o.idsite, o."user", o.k, o.n, o.code, '
        f"v.p0, v.p1, v.p2, {arrive} FROM v JOIN o ON o.idsite = v.idsite AND o.\"user\" = v.\"user\" AND o.k = v.k + 1)), "
        'path AS (SELECT idsite, "user", 0::INTEGER AS segment, CASE WHEN v0 = greatest(v0, v1, v2) THEN p0 '
        "WHEN v1 = greatest(v0, v1, v2) THEN p1 ELSE p2 END AS states FROM v WHERE k = n) " + final
    )


def _training_step() -> str:
    """Expected counts of one round by sums forwards and backwards over each history, and the model they give."""
    n, codes = range(3), "[" + ", ".join(f"'{o}'" for o in OBSERVABLE) + "]"

    def e(x: float) -> str:
        return f"{x!r}::DOUBLE"

    emit = ["[" + ", ".join(e(p) for p in row) + "]" for row in s.MODEL.emit]
    step = s.MODEL.step
    first = ", ".join(f"{e(p)} * {emit[i]}[code] AS a{i}" for i, p in enumerate(s.MODEL.start))
    forward = ", ".join("(" + " + ".join(f"a{i} * {e(step[i][j])}" for i in n) + f") * {emit[j]}[o.code] AS a{j}" for j in n)
    # w holds what came after k, and what was observed at k + 1
    backward = ", ".join(" + ".join(f"{e(step[i][j])} * {emit[j]}[w.code] * b{j}" for j in n) + f" AS b{i}" for i in n)
    same = 'o.idsite = w.idsite AND o."user" = w."user"'
    gamma = " UNION ALL ".join(f"SELECT {i} AS i, k, code, a{i} * b{i} / total AS g FROM m" for i in n)
    xi = " UNION ALL ".join(
        f"SELECT {i} AS i, {j} AS j, sum(m.a{i} * {e(step[i][j])} * {emit[j]}[x.code] * x.b{j} / m.total) AS g "
        'FROM m JOIN m x ON x.idsite = m.idsite AND x."user" = m."user" AND x.k = m.k + 1'
        for i in n for j in n
    )
    amount = f"CASE right({codes}[code], 1) WHEN 'L' THEN 0.0 WHEN 'S' THEN 1.0 ELSE 2.0 END"
    return f"""{_with(('st',), 'RECURSIVE')},
    o AS MATERIALIZED (SELECT idsite, "user", row_number() OVER w AS k, list_position({codes}, obs) AS code,
      count(*) OVER (PARTITION BY idsite, "user") AS n FROM st WINDOW w AS (PARTITION BY idsite, "user" ORDER BY "timestamp", idorder)),
    f AS (SELECT idsite, "user", k, n, code, {first} FROM o WHERE k = 1 UNION ALL
      SELECT o.idsite, o."user", o.k, o.n, o.code, {forward} FROM f w JOIN o ON {same} AND o.k = w.k + 1),
    b AS (SELECT idsite, "user", k, code, 1.0::DOUBLE AS b0, 1.0::DOUBLE AS b1, 1.0::DOUBLE AS b2 FROM o WHERE k = n UNION ALL
      SELECT o.idsite, o."user", o.k, o.code, {backward} FROM b w JOIN o ON {same} AND o.k = w.k - 1),
    m AS (SELECT f.*, b0, b1, b2, a0 * b0 + a1 * b1 + a2 * b2 AS total FROM f JOIN b USING (idsite, "user", k)),
    g AS ({gamma}), xi AS ({xi}),
    emits AS (SELECT i, code, sum(g) / (SELECT sum(g) FROM g WHERE g.i = z.i) AS p FROM g z GROUP BY i, code),
    place AS (SELECT i, ['L', 'N', 'H'][row_number() OVER (ORDER BY sum(p * {amount}))] AS h FROM emits GROUP BY i),
    every AS (SELECT i, unnest(range(1, {len(OBSERVABLE)} + 1)) AS code FROM place)
    SELECT 'start' AS part, '' AS state, h AS target, round(sum(g) / (SELECT sum(g) FROM g WHERE k = 1), 9) AS prob FROM g JOIN place USING (i) WHERE k = 1 GROUP BY h
    UNION ALL SELECT 'step', a.h, c.h, round(xi.g / sum(xi.g) OVER (PARTITION BY xi.i), 9) FROM xi JOIN place a ON a.i = xi.i JOIN place c ON c.i = xi.j
    UNION ALL SELECT 'emit', h, {codes}[code], round(coalesce(p, 0.0), 9) FROM every JOIN place USING (i) LEFT JOIN emits USING (i, code)"""


def _sliding(select: str) -> str:
    """Windows of 15 s every 2 s, aligned to the epoch."""
    return _sql(
        "view",
        f"""SELECT {select} FROM (SELECT visitor, ts,
        make_timestamp((epoch_us(ts) // 2000000 - i) * 2000000) AS start FROM view, range(0, 8) AS r(i)) z
        WHERE start + INTERVAL 15 SECOND > ts""",
    )


def _estimates(slide: int) -> str:
    """Exact counts and the five most frequent, per site and windows of a day every ``slide`` hours."""

    def top(column: str) -> str:
        return f"""(SELECT start, site, string_agg({column} || ':' || n, ' ' ORDER BY n DESC, {column}) AS top FROM (
        SELECT start, site, {column}, count(*) AS n FROM d GROUP BY start, site, {column}
        QUALIFY row_number() OVER (PARTITION BY start, site ORDER BY count(*) DESC, {column}) <= 5) GROUP BY ALL)"""

    seconds = slide * 3600
    return (
        _with(("view",))
        + f""", d AS (SELECT site, visitor, pageurl, make_timestamp((epoch_us(ts) // {seconds}000000 - i) * {seconds}000000) AS start
        FROM view, range(0, {24 // slide}) AS r(i))
        SELECT d.start, d.start + INTERVAL 1 DAY AS "end", d.site, count(*) AS views, count(DISTINCT pageurl) AS pages,
        count(DISTINCT visitor) AS visitors, any_value(p.top) AS top_pages, any_value(v.top) AS top_visitors
        FROM d JOIN {top('pageurl')} p USING (start, site) JOIN {top('visitor')} v USING (start, site) GROUP BY 1, 2, 3"""
    )


def build() -> dict[str, str]:
    q: dict[str, str] = {}

    q["scan_log"] = _sql(
        "item",
        f"SELECT idsite, {VISITOR.format('o_custkey')}, server_time, idorder, idaction_sku FROM item "
        f"WHERE idsite BETWEEN {s.SITE} AND {s.LAST_SITE}",
    )
    q["scan_conversion"] = _sql(
        "conv",
        f"""SELECT idsite, {VISITOR.format('conv.o_custkey')}, server_time, n_name AS location_country,
        r_name AS location_region, n_name || '-' || c_mktsegment AS location_city, lat AS location_latitude,
        lon AS location_longitude, idgoal, idorder, coalesce(items, 0)::INTEGER AS items,
        revenue_subtotal AS revenue, revenue_subtotal, tax AS revenue_tax, 0.0::DOUBLE AS revenue_shipping,
        discount AS revenue_discount FROM conv
        LEFT JOIN (SELECT l_orderkey, count(*) AS items, round(sum(l_extendedprice * l_discount), 4) AS discount,
          round(sum(l_extendedprice * l_tax), 4) AS tax FROM lineitem GROUP BY 1) l ON l_orderkey = o_orderkey
        LEFT JOIN customer ON c_custkey = conv.o_custkey
        LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey
        WHERE idsite = {s.SITE} AND {_window('server_time', s.START, s.END)}""",
    )
    q["scan_conversion_item"] = _sql(
        "item",
        f"""SELECT idsite, {VISITOR.format('o_custkey')}, server_time, idorder, idaction_sku, price, quantity, deleted
        FROM item WHERE idsite = {s.SITE} AND {_window('server_time', s.START, s.END)}""",
    )
    q["scan_visit_action"] = _sql(
        "visit",
        f"""SELECT idsite, {VISITOR.format('user_id')}, server_time, idvisit, idaction_url
        FROM visit WHERE idsite = {s.SITE} AND {_window('server_time', s.VISIT_START, s.VISIT_END)}""",
    )
    q["scan_piped_text"] = _sql("conv", 'SELECT "user", idorder, lat, lon FROM conv')
    q["sink_piped_text"] = _sql("near", "SELECT cluster, clat, clon, lat, lon FROM near")
    q["stream_source"] = _sql("view", 'SELECT site, visitor, pageurl, ts AS "timestamp" FROM view')
    q["stream_sink_json"] = _sql(
        "view",
        """SELECT '{"url":"' || pageurl || '","count":' || count(*) || '}' AS value
        FROM view GROUP BY date_trunc('day', ts), pageurl""",
    )
    q["stream_sink_visitor_json"] = (
        _sliding("""'{"visitor":"' || visitor || '","count":' || count(*) || '}' AS value""") + " GROUP BY start, visitor"
    )
    q["preferences_json"] = _sql(
        "score",
        """SELECT "user", 0::INTEGER AS part, '{"part":0,"parts":1,"items":[' || string_agg('{"user":"' || "user" || '","product":"' ||
        product || '","score":' || score || '}', ',' ORDER BY score DESC, product) || ']}' AS json FROM score GROUP BY "user" """,
    )

    q["visitor_hex"] = _sql("conv", 'SELECT idorder, "user" FROM conv')
    q["epoch_millis"] = _sql("visit", 'SELECT idvisit, idaction_url, "timestamp" FROM visit')
    q["filter_orders"] = _sql("conv", "SELECT idsite, idorder, idgoal FROM conv WHERE idgoal = 0")
    q["filter_not_deleted"] = _sql("kept", "SELECT idsite, idorder, idaction_sku, price FROM kept")
    q["project_fields"] = _sql("conv", "SELECT idsite, idorder, revenue_subtotal FROM conv")
    q["customer_key"] = _sql("conv", """SELECT idsite || '|' || "user" AS cid, idorder FROM conv""")
    q["pageview"] = _sql("view", "SELECT site, visitor, pageurl FROM view")
    q["categorical_items"] = _sql("wide", 'SELECT idsite, "user", idorder, item FROM wide')

    q["learned_categories"] = _sql(
        "kept conv",
        """SELECT DISTINCT idsite, "user", idorder, item FROM (
        SELECT idsite, "user", idorder, unnest(['buys=' || brand,
          'daytime=' || CASE WHEN hour(server_time) < 6 THEN 'night' WHEN hour(server_time) < 12 THEN 'morning'
            WHEN hour(server_time) < 18 THEN 'afternoon' ELSE 'evening' END,
          'quantity=' || CASE WHEN quantity <= q1 THEN 'low' WHEN quantity <= q2 THEN 'mid' ELSE 'high' END,
          'revenue=' || CASE WHEN price <= r1 THEN 'low' WHEN price <= r2 THEN 'mid' ELSE 'high' END]) AS item
        FROM kept, (SELECT quantile_disc(quantity, 1 / 3) AS q1, quantile_disc(quantity, 2 / 3) AS q2,
          quantile_disc(price, 1 / 3) AS r1, quantile_disc(price, 2 / 3) AS r2 FROM kept)
        UNION ALL
        SELECT idsite, "user", idorder, 'location=' || n_name FROM conv
        JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
        WHERE idorder IN (SELECT idorder FROM kept))""",
    )

    q["order_transactions"] = _sql(
        "conv",
        """SELECT idsite, "user", idorder, "timestamp", revenue_subtotal, revenue_discount FROM conv
        LEFT JOIN (SELECT l_orderkey, round(sum(l_extendedprice * l_discount), 4) AS revenue_discount
          FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey WHERE idgoal = 0""",
    )
    q["order_locations"] = _sql(
        "conv", 'SELECT idsite, "user", idorder, "timestamp", lat, lon FROM conv'
    )
    q["order_baskets"] = _sql(
        "basket", 'SELECT idsite, "user", idorder, segment, "timestamp", items FROM basket'
    )
    q["source_baskets"] = _sql(
        "kept",
        f"""SELECT idsite, "user", idorder, 0::INTEGER AS segment, min("timestamp") AS "timestamp",
        string_agg(CAST(idaction_sku AS VARCHAR), ' ' ORDER BY "timestamp", idaction_sku) AS items
        FROM kept WHERE idsite = {s.SITE} AND {_window('server_time', s.START, s.END)}
        GROUP BY idsite, "user", idorder""",
    )
    q["visit_paths"] = _sql(
        "visit",
        """SELECT idsite, "user", idvisit, 0::INTEGER AS segment, min("timestamp") AS "timestamp",
        string_agg(CAST(idaction_url AS VARCHAR), ' ' ORDER BY "timestamp", idaction_url) AS pages
        FROM visit GROUP BY idsite, "user", idvisit""",
    )
    q["customer_sequences"] = _sql(
        "basket",
        """SELECT idsite, "user", 0::INTEGER AS segment,
        string_agg(idorder || ':' || items, ';' ORDER BY "timestamp", idorder) AS baskets
        FROM basket GROUP BY idsite, "user" """,
    )
    q["numbered_baskets"] = _sql(
        "basket",
        """SELECT row_number() OVER (ORDER BY substr(md5(idorder || '|' || idsite || '|' || "user"), 1, 3),
        idorder, idsite, "user") - 1 AS lno, segment, items FROM basket""",
    )

    q["user_totals"] = _sql("totals", "SELECT cid, total FROM totals")
    q["user_item_support"] = _sql("support", "SELECT cid, item, supp FROM support")
    q["user_item_pref"] = _sql("pref", "SELECT cid, item, round(pref, 9) AS pref FROM pref")
    q["item_max_pref"] = _sql("mpref", "SELECT item, round(mpref, 9) AS mpref FROM mpref")
    q["preference_scores"] = _sql("score", 'SELECT "user", product, score FROM score')
    q["bounded_users"] = _sql("bounded", 'SELECT "user", product, score FROM bounded')
    terms = """(SELECT 'user' AS kind, "user" AS term FROM bounded GROUP BY 2
        UNION ALL SELECT 'product', product FROM bounded GROUP BY product)"""
    numbered = f"""SELECT kind, term, CAST(row_number() OVER (PARTITION BY kind
        ORDER BY substr(md5(term), 1, 3), term) - 1 AS INTEGER) AS idx FROM {terms}"""
    q["dictionary"] = _sql("bounded", f"SELECT kind, term, idx FROM ({numbered})")
    place = "row_number() OVER (PARTITION BY kind, version ORDER BY substr(md5(term), 1, 3), term) - 1"
    q["grown_dictionary"] = _sql(
        "kept",
        f"""SELECT kind, term, version::INTEGER AS version, CAST({place} + CASE WHEN version = 2 THEN
        count(*) FILTER (version = 1) OVER (PARTITION BY kind) ELSE 0 END AS INTEGER) AS idx FROM (
        SELECT kind, term, CASE WHEN min("timestamp") < epoch_ms(TIMESTAMP '{s.FIRST_VERSION}') THEN 1 ELSE 2 END AS version FROM (
        SELECT 'user' AS kind, idsite || '|' || "user" AS term, "timestamp" FROM kept
        UNION ALL SELECT 'product', CAST(idaction_sku AS VARCHAR), "timestamp" FROM kept) GROUP BY kind, term)""",
    )
    q["rating_matrix"] = (
        _with(("bounded",))
        + f""", num AS ({numbered}) SELECT u.idx AS uid, p.idx AS pid, score::DOUBLE AS rating FROM bounded
        JOIN num u ON u.kind = 'user' AND u.term = "user" JOIN num p ON p.kind = 'product' AND p.term = product"""
    )
    trained = "SELECT cid FROM brandline GROUP BY cid HAVING count(DISTINCT item) >= 10 AND count(DISTINCT item) < 20"
    q["als_train"] = _sql("brandline", f'SELECT cid AS "user", true AS solved FROM ({trained})')
    q["als_train_parts"] = _sql("line", f'SELECT cid AS "user", true AS solved FROM ({trained.replace("brandline", "line")})')
    q["model_store"] = _sql(
        "brandline",
        f"""SELECT side, {s.RANK}::INTEGER AS rank, terms, 'brands' AS model, 2000::BIGINT AS saved_at FROM (
        SELECT 'user' AS side, count(DISTINCT cid) AS terms FROM brandline WHERE cid IN ({trained})
        UNION ALL SELECT 'product', count(DISTINCT item) FROM brandline WHERE cid IN ({trained}))""",
    )
    q["predict_pairs"] = _sql(
        "factor",
        """SELECT u.term AS "user", p.term AS product, CAST(trunc(list_dot_product(u.f, p.f)) AS INTEGER) AS score,
        list_dot_product(u.f, p.f) AS rating FROM factor u JOIN factor p ON u.idx = p.idx
        WHERE u.kind = 'user' AND p.kind = 'product'""",
    )
    q["predict_user_items"] = _sql(
        "rated", 'SELECT "user", product, CAST(trunc(rating) AS INTEGER) AS score, rating FROM rated'
    )
    for name, rated in (("recommend_top_n", "rated"), ("recommend_everyone", "rated_part")):
        q[name] = _sql(
            rated,
            f"""SELECT "user", product, CAST(trunc(rating) AS INTEGER) AS score, rating FROM {rated}
            QUALIFY row_number() OVER (PARTITION BY "user" ORDER BY rating DESC, product) <= {s.TOP_N}""",
        )

    q["fold_in"] = (
        _with(("brandline", "factor"))
        + f""", sc AS (SELECT cid, item, floor(5.0::DOUBLE * (pref / max(pref) OVER (PARTITION BY item)) + 0.5::DOUBLE) AS r
        FROM (SELECT cid, item, ln(1.0::DOUBLE + count(*)::DOUBLE / any_value(total)::DOUBLE) AS pref FROM brandline
          JOIN (SELECT cid, count(DISTINCT idorder) AS total FROM brandline GROUP BY cid) USING (cid) GROUP BY cid, item)),
        e AS (SELECT cid, sum(f[1] * f[1]) + {s.FOLD_LAMBDA}::DOUBLE * count(*) AS a, sum(f[1] * f[2]) AS b,
          sum(f[2] * f[2]) + {s.FOLD_LAMBDA}::DOUBLE * count(*) AS c, sum(f[1] * r) AS p, sum(f[2] * r) AS q
          FROM sc JOIN factor ON kind = 'product' AND term = CAST(item AS VARCHAR) GROUP BY cid HAVING count(*) < 10 OR count(*) >= 20)
        SELECT cid AS "user", round((c * p - b * q) / (a * c - b * b), 6) AS f1, round((a * q - b * p) / (a * c - b * b), 6) AS f2 FROM e"""
    )

    q["transaction_states"] = _sql(
        "st",
        'SELECT idsite, "user", idorder, "timestamp", gap, round(ratio, 6) AS ratio, state FROM st',
    )
    q["state_sequences"] = _sql(
        "st",
        """SELECT idsite, "user", 0::INTEGER AS segment, string_agg(state, ' ' ORDER BY "timestamp", idorder) AS states
        FROM st GROUP BY idsite, "user" """,
    )
    q["transition_counts"] = _sql("tc", 'SELECT idsite, "user", state, next, n FROM tc')
    q["transition_probs"] = _sql(
        "tc",
        """SELECT idsite, "user", state, next, n,
        round(n / sum(n) OVER (PARTITION BY idsite, "user", state), 9) AS prob FROM tc""",
    )
    q["next_state"] = _sql(
        "ahead", 'SELECT idsite, "user", state, next, round(prob, 9) AS prob, basis FROM ahead'
    )
    q["purchase_horizon"] = (
        _with(("ahead", "st", "tx"))
        + """, gown AS (SELECT idsite, "user", t, avg(gap::DOUBLE) AS g FROM st GROUP BY ALL),
        gsite AS (SELECT idsite, t, avg(gap::DOUBLE) AS g FROM st GROUP BY ALL),
        rown AS (SELECT idsite, "user", a, avg(ratio) AS r FROM st GROUP BY ALL),
        rsite AS (SELECT idsite, a, avg(ratio) AS r FROM st GROUP BY ALL),
        l AS (SELECT * FROM tx QUALIFY row_number() OVER (PARTITION BY idsite, "user"
          ORDER BY "timestamp" DESC, idorder DESC) = 1)
        SELECT l.idsite, l."user", CASE WHEN h.state IS NOT NULL THEN h.next END AS next,
        CASE WHEN h.state IS NOT NULL THEN
          l."timestamp" + CAST(floor(coalesce(go.g, gs.g) + 0.5::DOUBLE) AS BIGINT) END AS next_timestamp,
        CASE WHEN h.state IS NOT NULL THEN
          round(l.revenue_subtotal * coalesce(ro.r, rs.r), 2) END AS next_amount
        FROM l JOIN ahead h ON h.idsite = l.idsite AND h."user" = l."user"
        LEFT JOIN gown go ON go.idsite = l.idsite AND go."user" = l."user" AND go.t = substr(h.next, 1, 1)
        LEFT JOIN gsite gs ON gs.idsite = l.idsite AND gs.t = substr(h.next, 1, 1)
        LEFT JOIN rown ro ON ro.idsite = l.idsite AND ro."user" = l."user" AND ro.a = substr(h.next, 2, 1)
        LEFT JOIN rsite rs ON rs.idsite = l.idsite AND rs.a = substr(h.next, 2, 1)"""
    )
    q["loyalty_observations"] = _sql(
        "st", 'SELECT idsite, "user", idorder, "timestamp", obs AS state FROM st'
    )
    q["hmm_step"] = _training_step()
    q["loyalty_states"] = _viterbi('SELECT idsite, "user", segment, states FROM path')
    q["loyalty_trend"] = _viterbi(
        """SELECT idsite, "user", CASE WHEN count(*) > 1 THEN round(regr_slope(level, pos), 9) END AS slope,
        count(*) AS n, count(*) > 1 AND round(regr_slope(level, pos), 12) < 0 AS downward FROM (
        SELECT idsite, "user", generate_subscripts(x, 1)::DOUBLE AS pos,
          (list_position(['L', 'N', 'H'], unnest(x)) - 1)::DOUBLE AS level
        FROM (SELECT idsite, "user", string_split(states, ' ') AS x FROM path)) GROUP BY idsite, "user" """
    )

    brands = _itemsets("brandline", "idorder", "brandline", s.ITEMSET_SUPPORT, 4)
    q["frequent_itemsets"] = f"{brands} SELECT array_to_string(items, ' ') AS items, support FROM sets"
    parts = _itemsets("line", "idorder", "line", s.PART_SUPPORT, 3)
    q["part_itemsets"] = f"{parts} SELECT array_to_string(items, ' ') AS items, support FROM sets"
    q["top_k_rules"] = _top_rules(brands, s.RULE_CONFIDENCE)
    q["also_bought"] = (
        f"{brands}, have AS (SELECT cid, idorder, list(item) AS items FROM brandline GROUP BY ALL) "
        "SELECT CAST(split_part(cid, '|', 1) AS BIGINT) AS idsite, split_part(cid, '|', 2) AS \"user\", idorder, "
        "consequent AS item, round(max(confidence), 9) AS confidence FROM have JOIN rule "
        f"ON list_has_all(have.items, antecedent) AND NOT list_contains(have.items, consequent) "
        f"WHERE confidence >= {s.RULE_CONFIDENCE}::DOUBLE GROUP BY ALL"
    )
    q["multi_predicate_rules"] = _top_rules(
        _itemsets("wide", "idorder", "wide", s.CATEGORY_SUPPORT, 6), s.CATEGORY_CONFIDENCE
    )
    q["page_rules"] = _top_rules(
        _itemsets(
            "(SELECT idvisit, idaction_url AS item FROM visit)", "idvisit", "visit", s.PAGE_SUPPORT, 4
        ),
        s.PAGE_CONFIDENCE,
    )
    q["sequence_patterns"] = _patterns(5)
    q["sequence_groups"] = _sql("grp", "SELECT cid, head, copies FROM grp")
    q["customer_similarity"] = _sql(
        "sim", f"SELECT a, b, similarity FROM sim WHERE a < b AND similarity >= {s.SIMILARITY}::DOUBLE"
    )
    q["close_customers"] = _sql(
        "sim", f"SELECT a, b, similarity FROM sim WHERE a < b AND similarity >= {s.CLOSE}::DOUBLE"
    )
    q["similar_histories"] = _sql(
        "sim grp",
        f"""SELECT a, b, similarity FROM sim WHERE a < b AND similarity >= {s.SIMILARITY}::DOUBLE
        AND a IN (SELECT head FROM grp) AND b IN (SELECT head FROM grp)""",
    )
    q["top_k_similar"] = _sql(
        "sim selected",
        f"""SELECT a, b, similarity, CAST(rank AS INTEGER) AS rank FROM (SELECT a, b, similarity,
        row_number() OVER (PARTITION BY a ORDER BY similarity DESC, b) AS rank FROM sim
        WHERE a IN (SELECT cid FROM selected)) WHERE rank <= {s.TOP_SIMILAR}""",
    )

    q["geo_clusters"] = _sql("conv", "SELECT lat, lon, true AS nearest, true AS centred FROM conv")
    q["cluster_pixels"] = _sql("pix", "SELECT x, y, true AS centred FROM pix")
    q["customer_segments"] = _sql(
        "tx kept", 'SELECT idsite, "user", idorder, true AS nearest FROM tx WHERE idorder IN (SELECT idorder FROM kept)'
    )
    q["assign_clusters"] = _sql("near", "SELECT cluster, clat, clon, lat, lon FROM near")
    q["project_pixels"] = _sql(
        "conv",
        f"""SELECT idorder, CAST(trunc({s.WIDTH}::DOUBLE * (0.5::DOUBLE + lon / 360.0::DOUBLE)) AS INTEGER) AS x,
        CAST(trunc({s.HEIGHT}::DOUBLE * (0.5::DOUBLE - lat / 180.0::DOUBLE)) AS INTEGER) AS y FROM conv""",
    )
    q["cluster_pixels_fixed"] = _sql("pix", "SELECT cluster, cx, cy, x, y FROM pix")
    for suffix in ("", "_fine"):
        q[f"pixel_heat{suffix}"] = _sql(f"heat{suffix}", f"SELECT x, y, heat FROM heat{suffix}")
        q[f"point_heat{suffix}"] = _sql(f"points{suffix}", f"SELECT x, y, heat FROM points{suffix}")

    def channel(expression: str) -> str:
        return f"CAST(trunc(least(greatest({expression}, 0.0::DOUBLE), 255.0::DOUBLE)) AS INTEGER)"

    def colours(share: str) -> str:
        return (
            _with(("heat",))
            + f""", z AS (SELECT x, y, {share} / 0.7::DOUBLE AS w FROM heat)
        SELECT x, y,
        CASE WHEN w < 0.5 THEN 0 WHEN w < 0.75 THEN {channel('255 * (0.75 - w) / 0.25')}
             ELSE {channel('255 * (w - 0.75) / 0.25')} END AS r,
        CASE WHEN w < 0.25 THEN 0 WHEN w < 0.5 THEN {channel('255 * (w - 0.25) / 0.25')} WHEN w < 0.75 THEN 255
             ELSE {channel('255 * (1.0 - w) / 0.25')} END AS g,
        CASE WHEN w < 0.25 THEN {channel('255 * w / 0.25')} WHEN w < 0.5 THEN {channel('255 * (0.5 - w) / 0.25')}
             ELSE 0 END AS b, 200 AS a FROM z"""
        )

    q["heat_colour"] = colours("heat")
    q["heat_share_colour"] = colours("round(heat / (SELECT max(heat) FROM heat), 6)")

    q["page_counts"] = _sql(
        "view",
        """SELECT date_trunc('second', ts) AS start, date_trunc('second', ts) + INTERVAL 1 SECOND AS "end",
        pageurl AS url, count(*) AS count FROM view GROUP BY 1, 2, 3""",
    )
    q["visitor_counts"] = (
        _sliding('start, start + INTERVAL 15 SECOND AS "end", visitor, count(*) AS count')
        + " GROUP BY start, visitor"
    )
    q["visitor_counts_stream"] = q["visitor_counts_keyed"] = q["visitor_counts"]
    q["clickstream_estimates"] = q["clickstream_stored"] = _estimates(24)
    q["clickstream_sliding"] = _estimates(6)
    q["distinct_visitors"] = (
        _sliding('start, start + INTERVAL 15 SECOND AS "end", count(DISTINCT visitor) AS visitors')
        + " GROUP BY start"
    )
    q["distinct_visitors_keyed"] = q["distinct_visitors"]
    return q
