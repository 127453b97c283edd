"""The registered queries as plain SQL for the oracle engine.

Written from the definitions and not from the library's plans: spines come
from a calendar, the as-of lookup compares timestamps, occupancy is an EXISTS.
Named relations are written once below; a query pulls in the ones it mentions.
"""

from __future__ import annotations

import re

from catalog.shapes import GIVEN_TABLES, SHAPES, SOURCE_TABLES, shape_sql

FIRST_LOAD = "TIMESTAMP '2024-03-01 00:00:00'"
SECOND_LOAD = "TIMESTAMP '2024-03-31 00:00:00'"
LOADS = {1: FIRST_LOAD, 2: SECOND_LOAD}
OPEN_END = "TIMESTAMP '9999-12-31 23:59:59'"

DATES = {
    "date_of_birth",
    "registration_date",
    "release_date",
    "purchase_date",
    "rental_date",
    "due_date",
    "return_date",
    "full_date",
    "activity_date",
    "month_start",
}
TIMESTAMPS = {
    "created_at",
    "updated_at",
    "load_timestamp",
    "start_time",
    "end_time",
    "review_date",
    "added_date",
    "payment_date",
    "opened_date",
    "closed_date",
    "effective_from",
    "effective_to",
    "ended_by",
    "last_watermark",
}
DECIMALS = {
    "completion_percentage",
    "rating",
    "rental_fee",
    "late_fee",
    "amount",
    "total_amount_spent",
    "revenue_generated",
    "utilisation_percentage",
}

LINEAGE = ("created_at", "updated_at", "load_timestamp", "source_system")

COLUMNS: dict[str, tuple[str, ...]] = {
    "country": ("country_id", "country_name", "country_code"),
    "city": ("city_id", "country_id", "city_name"),
    "customer": (
        "customer_id",
        "customer_no",
        "first_name",
        "last_name",
        "email",
        "phone",
        "date_of_birth",
        "gender",
        "registration_date",
        "status",
    ),
    "customer_address": (
        "address_id",
        "customer_id",
        "city_id",
        "address_line",
        "postal_code",
        "address_type",
    ),
    "content_type": ("content_type_id", "content_type"),
    "content": (
        "content_id",
        "content_type_id",
        "title",
        "release_date",
        "duration_minutes",
        "language",
        "age_rating",
    ),
    "genre": ("genre_id", "genre_name"),
    "content_genre": ("content_id", "genre_id"),
    "streaming_session": (
        "stream_id",
        "customer_id",
        "content_id",
        "device_id",
        "start_time",
        "end_time",
        "watch_duration",
        "completion_percentage",
    ),
    "review": ("review_id", "customer_id", "content_id", "rating", "review_text", "review_date"),
    "wishlist": ("wishlist_id", "customer_id", "content_id", "added_date"),
    "warehouse": ("warehouse_id", "city_id", "warehouse_name"),
    "inventory_item": (
        "inventory_id",
        "content_id",
        "warehouse_id",
        "barcode",
        "purchase_date",
        "item_condition",
        "status",
    ),
    "rental": (
        "rental_id",
        "customer_id",
        "inventory_id",
        "rental_date",
        "due_date",
        "return_date",
        "rental_fee",
        "late_fee",
        "status",
    ),
    "payment": (
        "payment_id",
        "customer_id",
        "rental_id",
        "subscription_id",
        "payment_method_id",
        "amount",
        "payment_date",
        "payment_type",
        "status",
    ),
    "support_ticket": (
        "ticket_id",
        "customer_id",
        "category_id",
        "opened_date",
        "closed_date",
        "priority",
        "status",
    ),
}


def _text(c: str) -> str:
    return f"nullif(trim({c}, ' '), '')"


def _title(c: str) -> str:
    pieces = rf"regexp_extract_all(lower({_text(c)}), '([\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+)', 1)"
    capital = "lambda w: upper(substr(w, 1, 1)) || substr(w, 2)"
    return f"array_to_string(list_transform({pieces}, {capital}), '')"


# Column replacements and conditions per Silver table. {now} is the load's
# time, {n} the load's number.
_TIMES = (
    "(created_at IS NULL OR created_at <= {now}) AND (updated_at IS NULL OR updated_at <= {now})"
    " AND (created_at IS NULL OR updated_at IS NULL OR created_at <= updated_at)"
)
_KNOWN = "{0} IN (SELECT {0} FROM silver{{n}}_{1})"
_CUSTOMER_KNOWN = _KNOWN.format("customer_id", "customer")
_CONTENT_KNOWN = _KNOWN.format("content_id", "content")

_SILVER: dict[str, tuple[dict[str, str], list[str]]] = {
    "country": (
        {"country_name": _text("country_name"), "country_code": f"upper({_text('country_code')})"},
        ["country_name IS NOT NULL", "coalesce(length(country_code), 2) = 2"],
    ),
    "city": (
        {"city_name": _text("city_name")},
        ["city_name IS NOT NULL", _KNOWN.format("country_id", "country")],
    ),
    "customer": (
        {
            **{c: _text(c) for c in ("customer_no", "first_name", "last_name", "phone")},
            "email": f"lower({_text('email')})",
            "gender": f"upper({_text('gender')})",
            "status": f"upper({_text('status')})",
        },
        [
            "customer_no IS NOT NULL AND first_name IS NOT NULL AND last_name IS NOT NULL",
            "coalesce(date_of_birth <= CAST({now} AS DATE), TRUE)",
            "coalesce(registration_date <= CAST({now} AS DATE), TRUE)",
            "coalesce(date_of_birth <= registration_date, TRUE)",
        ],
    ),
    "customer_address": (
        {
            "address_line": _text("address_line"),
            "postal_code": _text("postal_code"),
            "address_type": f"upper({_text('address_type')})",
        },
        [
            "address_line IS NOT NULL",
            _CUSTOMER_KNOWN,
            f"(city_id IS NULL OR {_KNOWN.format('city_id', 'city')})",
            _TIMES,
        ],
    ),
    "content_type": (
        {"content_type": _text("content_type")},
        ["content_type IS NOT NULL", _TIMES],
    ),
    "content": (
        {
            "title": _text("title"),
            "language": _title("language"),
            "age_rating": f"upper({_text('age_rating')})",
        },
        [
            "title IS NOT NULL",
            _KNOWN.format("content_type_id", "content_type"),
            "release_date <= CAST({now} AS DATE)",
            "(duration_minutes IS NULL OR duration_minutes >= 0)",
            _TIMES,
        ],
    ),
    "genre": ({"genre_name": _title("genre_name")}, ["genre_name IS NOT NULL", _TIMES]),
    "content_genre": ({}, [_CONTENT_KNOWN, _KNOWN.format("genre_id", "genre"), _TIMES]),
    "streaming_session": (
        {},
        [
            "start_time IS NOT NULL",
            _CUSTOMER_KNOWN,
            _CONTENT_KNOWN,
            "(end_time IS NULL OR end_time >= start_time)",
            "(watch_duration IS NULL OR watch_duration >= 0)",
            "(completion_percentage IS NULL OR completion_percentage BETWEEN 0 AND 100)",
            _TIMES,
        ],
    ),
    "review": (
        {"review_text": _text("review_text")},
        [
            _CUSTOMER_KNOWN,
            _CONTENT_KNOWN,
            "rating BETWEEN 0 AND 5",
            "review_date <= {now}",
            _TIMES,
        ],
    ),
    "wishlist": ({}, [_CUSTOMER_KNOWN, _CONTENT_KNOWN, "added_date <= {now}", _TIMES]),
    "warehouse": (
        {"warehouse_name": _title("warehouse_name")},
        [f"(city_id IS NULL OR {_KNOWN.format('city_id', 'city')})", _TIMES],
    ),
    "inventory_item": (
        {
            "barcode": _text("barcode"),
            "item_condition": f"upper({_text('item_condition')})",
            "status": f"upper({_text('status')})",
        },
        [
            "barcode IS NOT NULL AND item_condition IS NOT NULL AND status IS NOT NULL",
            "NOT EXISTS (SELECT 1 FROM clean{n}_inventory_item o"
            " WHERE o.barcode = c.barcode AND o.inventory_id <> c.inventory_id)",
            _CONTENT_KNOWN,
            _KNOWN.format("warehouse_id", "warehouse"),
            "(purchase_date IS NULL OR purchase_date <= CAST({now} AS DATE))",
            _TIMES,
        ],
    ),
    "rental": (
        {"status": f"upper({_text('status')})"},
        [
            "due_date IS NOT NULL AND rental_fee >= 0 AND status IS NOT NULL",
            _CUSTOMER_KNOWN,
            _KNOWN.format("inventory_id", "inventory_item"),
            "rental_date <= CAST({now} AS DATE) AND due_date >= rental_date",
            "(return_date IS NULL OR return_date >= rental_date)",
            "(late_fee IS NULL OR late_fee >= 0)",
            _TIMES,
        ],
    ),
    "payment": (
        {"payment_type": f"upper({_text('payment_type')})", "status": f"upper({_text('status')})"},
        [
            "amount >= 0 AND payment_type IS NOT NULL AND status IS NOT NULL",
            _CUSTOMER_KNOWN,
            f"(rental_id IS NULL OR {_KNOWN.format('rental_id', 'rental')})",
            "payment_date <= {now}",
            _TIMES,
        ],
    ),
    "support_ticket": (
        {"priority": f"upper({_text('priority')})", "status": f"upper({_text('status')})"},
        [
            "priority IS NOT NULL AND status IS NOT NULL",
            _CUSTOMER_KNOWN,
            "opened_date <= {now}",
            "(closed_date IS NULL OR closed_date BETWEEN opened_date AND {now})",
            _TIMES,
        ],
    ),
}

# What newest versions are checked for, in order: columns that must be there, then conditions, then parents.
_PAST_DAY, _PAST = "{0} <= CAST({{now}} AS DATE)", "{0} <= {{now}}"
_CHANGE_TIMES = [
    ("created_at in the future", _PAST.format("created_at")),
    ("updated_at in the future", _PAST.format("updated_at")),
    ("updated_at before created_at", "updated_at >= created_at"),
]
_CUSTOMER, _CONTENT = ("customer_id", "customer", False), ("content_id", "content", False)
_CHECKS: dict[str, tuple[str, list[tuple[str, str]], list[tuple[str, str, bool]]]] = {
    "country": ("country_name", [("country_code not of length 2", "length(country_code) = 2")], []),
    "city": ("country_id city_name", [], [("country_id", "country", False)]),
    "customer": (
        "customer_no first_name last_name",
        [
            ("date_of_birth in the future", _PAST_DAY.format("date_of_birth")),
            ("registration_date in the future", _PAST_DAY.format("registration_date")),
            ("registration_date before date_of_birth", "registration_date >= date_of_birth"),
        ],
        [],
    ),
    "customer_address": ("customer_id address_line", _CHANGE_TIMES, [_CUSTOMER, ("city_id", "city", True)]),
    "content_type": ("content_type", _CHANGE_TIMES, []),
    "content": (
        "title content_type_id release_date",
        [
            ("release_date in the future", _PAST_DAY.format("release_date")),
            ("duration_minutes negative", "duration_minutes >= 0"),
            *_CHANGE_TIMES,
        ],
        [("content_type_id", "content_type", False)],
    ),
    "genre": ("genre_name", _CHANGE_TIMES, []),
    "content_genre": ("", _CHANGE_TIMES, [_CONTENT, ("genre_id", "genre", False)]),
    "streaming_session": (
        "customer_id content_id start_time",
        [
            ("end_time before start_time", "end_time >= start_time"),
            ("watch_duration negative", "watch_duration >= 0"),
            ("completion_percentage not in 0..100", "completion_percentage BETWEEN 0 AND 100"),
            *_CHANGE_TIMES,
        ],
        [_CUSTOMER, _CONTENT],
    ),
    "review": (
        "customer_id content_id rating review_date",
        [
            ("rating not in 0..5", "rating BETWEEN 0 AND 5"),
            ("review_date in the future", _PAST.format("review_date")),
            *_CHANGE_TIMES,
        ],
        [_CUSTOMER, _CONTENT],
    ),
    "wishlist": (
        "customer_id content_id added_date",
        [("added_date in the future", _PAST.format("added_date")), *_CHANGE_TIMES],
        [_CUSTOMER, _CONTENT],
    ),
    "warehouse": ("", _CHANGE_TIMES, [("city_id", "city", True)]),
    "inventory_item": (
        "content_id warehouse_id barcode item_condition status",
        [("purchase_date in the future", _PAST_DAY.format("purchase_date")), *_CHANGE_TIMES],
        [_CONTENT, ("warehouse_id", "warehouse", False)],
    ),
    "rental": (
        "customer_id inventory_id rental_date due_date rental_fee status",
        [
            ("rental_date in the future", _PAST_DAY.format("rental_date")),
            ("due_date before rental_date", "due_date >= rental_date"),
            ("return_date before rental_date", "return_date >= rental_date"),
            ("rental_fee negative", "rental_fee >= 0"),
            ("late_fee negative", "late_fee >= 0"),
            *_CHANGE_TIMES,
        ],
        [_CUSTOMER, ("inventory_id", "inventory_item", False)],
    ),
    "payment": (
        "customer_id amount payment_date payment_type status",
        [
            ("payment_date in the future", _PAST.format("payment_date")),
            ("amount negative", "amount >= 0"),
            *_CHANGE_TIMES,
        ],
        [_CUSTOMER, ("rental_id", "rental", True)],
    ),
    "support_ticket": (
        "customer_id opened_date priority status",
        [
            ("opened_date in the future", _PAST.format("opened_date")),
            ("closed_date before opened_date", "closed_date >= opened_date"),
            ("closed_date in the future", _PAST.format("closed_date")),
            *_CHANGE_TIMES,
        ],
        [_CUSTOMER],
    ),
}


def _reject_sql() -> str:
    parts = []
    for table, (required, conditions, parents) in _CHECKS.items():
        key = ("content_id", "genre_id") if table == "content_genre" else COLUMNS[table][:1]
        has_key = " AND ".join(f"{k} IS NOT NULL" for k in key)
        ties = ", ".join(f"{c} ASC NULLS FIRST" for c in (*[c for c in COLUMNS[table] if c not in key], "source_system"))
        replaced = ", ".join(f"{sql} AS {c}" for c, sql in _SILVER[table][0].items())
        cases = []
        if table == "inventory_item":
            cases.append(("barcode shared", "barcode IN (SELECT barcode FROM n GROUP BY barcode HAVING count(*) > 1)"))
        cases += [(f"{c} missing", f"{c} IS NULL") for c in required.split()]
        cases += [(name, f"NOT ({sql})") for name, sql in conditions]
        for column, parent, optional in parents:
            unknown = f"NOT EXISTS (SELECT 1 FROM silver2_{parent} AS p WHERE p.{column} = n.{column})"
            cases.append((f"{column} unknown", f"{column} IS NOT NULL AND {unknown}" if optional else unknown))
        case = " ".join(f"WHEN {sql} THEN '{name}'" for name, sql in cases).format(now=SECOND_LOAD)
        key_text = ", ".join(f"coalesce(CAST({k} AS VARCHAR), '')" for k in key)
        times = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in LINEAGE[:3])
        columns = f"'{table}' AS table_name, concat_ws(',', {key_text}) AS row_key, {{}} AS reason, {times}"
        early = f"CASE WHEN {has_key} THEN 'superseded' ELSE 'key missing' END"
        parts.append(f"""
            SELECT * FROM (
                WITH v AS (
                    SELECT *, row_number() OVER (PARTITION BY {', '.join(key)} ORDER BY updated_at DESC NULLS LAST,
                        created_at DESC NULLS LAST, load_timestamp DESC NULLS FIRST, {ties}) AS place
                    FROM bronze2_{table}
                ), n AS (
                    SELECT * {f'REPLACE ({replaced})' if replaced else ''} FROM v WHERE {has_key} AND place = 1
                )
                SELECT {columns.format(early)} FROM v WHERE NOT ({has_key}) OR place > 1
                UNION ALL
                SELECT * FROM (SELECT {columns.format(f"CASE {case} END")} FROM n) AS judged WHERE reason IS NOT NULL
            ) AS {table}_rejects""")
    return " UNION ALL ".join(parts)


RELATIONS: dict[str, str] = {}


def _source_relations() -> None:
    names = {t: t for t in GIVEN_TABLES}
    for table in SHAPES:
        for n, later in ((1, False), (2, True)):
            RELATIONS[f"source{n}_{table}"] = shape_sql(table, later, "TIMESTAMP").format(**names)
    for table in SOURCE_TABLES:
        lineage = "CAST({} AS TIMESTAMP) AS load_timestamp, 'SOURCE_OLTP' AS source_system"
        RELATIONS[f"bronze1_{table}"] = (
            f"SELECT *, {lineage.format(FIRST_LOAD)} FROM source1_{table}"
        )
        RELATIONS[f"watermark_{table}"] = (
            "SELECT coalesce(greatest(max(created_at), max(updated_at)),"
            f" TIMESTAMP '1900-01-01 00:00:00') AS last_watermark FROM bronze1_{table}"
        )
        RELATIONS[f"delta_{table}"] = (
            f"SELECT *, {lineage.format(SECOND_LOAD)} FROM source2_{table}"
            " WHERE greatest(created_at, updated_at) >"
            f" (SELECT last_watermark FROM watermark_{table})"
            f" AND greatest(created_at, updated_at) <= {SECOND_LOAD}"
        )
        RELATIONS[f"bronze2_{table}"] = (
            f"SELECT * FROM bronze1_{table} UNION ALL SELECT * FROM delta_{table}"
        )


def _silver_relations() -> None:
    for table, (cleaned, conditions) in _SILVER.items():
        key = ("content_id", "genre_id") if table == "content_genre" else COLUMNS[table][:1]
        rest = [c for c in COLUMNS[table] if c not in key]
        ties = ", ".join(f"{c} ASC NULLS FIRST" for c in (*rest, "source_system"))
        replaced = ", ".join(f"{sql} AS {c}" for c, sql in cleaned.items())
        for n, now in LOADS.items():
            newest = (
                f"SELECT * FROM bronze{n}_{table}"
                f" WHERE {' AND '.join(f'{k} IS NOT NULL' for k in key)}"
                f" QUALIFY row_number() OVER (PARTITION BY {', '.join(key)}"
                " ORDER BY updated_at DESC NULLS LAST, created_at DESC NULLS LAST,"
                f" load_timestamp DESC NULLS FIRST, {ties}) = 1"
            )
            star = f"* REPLACE ({replaced})" if replaced else "*"
            RELATIONS[f"clean{n}_{table}"] = f"SELECT {star} FROM ({newest}) AS newest"
            RELATIONS[f"silver{n}_{table}"] = (
                f"SELECT {', '.join((*COLUMNS[table], *LINEAGE))} FROM clean{n}_{table} AS c WHERE "
            ) + " AND ".join(conditions).format(now=now, n=n)


def _profile_relations() -> None:
    for n, now in LOADS.items():
        lineage = f"created_at, updated_at, {now} AS load_timestamp, source_system"
        RELATIONS[f"profile{n}_customer"] = f"""
            WITH home AS (
                SELECT a.customer_id, ci.city_name, co.country_name
                FROM silver{n}_customer_address a
                LEFT JOIN silver{n}_city ci USING (city_id)
                LEFT JOIN silver{n}_country co ON co.country_id = ci.country_id
                WHERE a.address_type = 'HOME'
            )
            SELECT c.customer_id, customer_no, concat_ws(' ', first_name, last_name) AS full_name, email,
                CAST(date_part('year', age(CAST({now} AS TIMESTAMP), CAST(date_of_birth AS TIMESTAMP))) AS INT) AS age,
                city_name, country_name, status, {lineage}
            FROM silver{n}_customer c LEFT JOIN home h ON h.customer_id = c.customer_id"""
        RELATIONS[f"profile{n}_content"] = f"""
            WITH main AS (
                SELECT content_id, arg_min(genre_name, genre_id) AS primary_genre
                FROM silver{n}_content_genre JOIN silver{n}_genre USING (genre_id) GROUP BY content_id
            )
            SELECT c.content_id, title, t.content_type AS content_type_name, primary_genre,
                CAST(year(release_date) AS INT) AS release_year,
                c.created_at, c.updated_at, {now} AS load_timestamp, c.source_system
            FROM silver{n}_content c
            LEFT JOIN silver{n}_content_type t ON t.content_type_id = c.content_type_id
            LEFT JOIN main ON main.content_id = c.content_id"""
        RELATIONS[f"profile{n}_inventory_item"] = f"""
            SELECT i.inventory_id, i.barcode, c.title AS content_title, w.warehouse_name,
                ci.city_name AS warehouse_city, i.item_condition,
                i.created_at, i.updated_at, {now} AS load_timestamp, i.source_system
            FROM silver{n}_inventory_item i
            LEFT JOIN silver{n}_content c ON c.content_id = i.content_id
            LEFT JOIN silver{n}_warehouse w ON w.warehouse_id = i.warehouse_id
            LEFT JOIN silver{n}_city ci ON ci.city_id = w.city_id"""


PROFILE_COLUMNS = {
    "customer": (
        "customer_id",
        "customer_no",
        "full_name",
        "email",
        "age",
        "city_name",
        "country_name",
        "status",
    ),
    "content": ("content_id", "title", "content_type_name", "primary_genre", "release_year"),
    "inventory_item": (
        "inventory_id",
        "barcode",
        "content_title",
        "warehouse_name",
        "warehouse_city",
        "item_condition",
    ),
}

# Surrogate key, business key, tracked columns, anchor.
_DIMENSIONS = {
    "customer": (
        "customer_sk",
        "customer_no",
        ("full_name", "email", "age", "city_name", "country_name", "status"),
        "2023-01-01",
    ),
    "content": (
        "content_sk",
        "content_id",
        ("title", "content_type_name", "primary_genre", "release_year"),
        "2023-01-01",
    ),
    "inventory_item": (
        "inventory_sk",
        "barcode",
        ("content_title", "warehouse_name", "warehouse_city", "item_condition"),
        "2018-01-01",
    ),
}


def dimension_columns(name: str) -> tuple[str, ...]:
    surrogate, key, tracked, _ = _DIMENSIONS[name]
    periods = ("effective_from", "effective_to", "is_current")
    return (surrogate, key, *tracked, *periods, "created_at", "updated_at", "source_system")


def _key_part(column: str) -> str:
    text = f"CAST({column} AS VARCHAR)"
    return f"coalesce(length({text}) || ':' || {text}, 'N')"


def _version_key(key: str, tracked: tuple[str, ...]) -> str:
    parts = [_key_part(c) for c in (key, "effective_from", *tracked)]
    half = f"CAST(('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 16)) AS UBIGINT)"
    wide = f"CAST({half} AS HUGEINT)"
    return (
        f"CAST(CASE WHEN {wide} >= 9223372036854775808"
        f" THEN {wide} - 18446744073709551616 ELSE {wide} END AS BIGINT)"
    )


def _merge_sql(name: str, dimension: str | None, profile: str) -> str:
    """The three steps one after another: close, new keys, new versions."""
    surrogate, key, tracked, anchor = _DIMENSIONS[name]
    columns = dimension_columns(name)
    plain = ", ".join(columns[1:])
    attributes = ", ".join((key, *tracked))
    tail = f"{OPEN_END} AS effective_to, TRUE AS is_current, created_at, updated_at, source_system"
    new_key = f"SELECT {attributes}, TIMESTAMP '{anchor} 00:00:00' AS effective_from, {tail} FROM {profile} s"
    keyed = f"SELECT {_version_key(key, tracked)} AS {surrogate}, {plain} FROM"
    if dimension is None:
        return f"{keyed} ({new_key}) AS inserted"
    differs = " OR ".join(f"t.{c} IS DISTINCT FROM s.{c}" for c in tracked)
    closing = (
        f"(SELECT max(s.updated_at) FROM {profile} s WHERE s.{key} = t.{key}"
        f" AND t.is_current AND s.updated_at > t.effective_from AND ({differs}))"
    )
    return f"""
        WITH marked AS (SELECT *, {closing} AS closing FROM {dimension} t),
        after_close AS (
            SELECT {', '.join(columns[: 2 + len(tracked)])}, effective_from,
                coalesce(closing, effective_to) AS effective_to,
                is_current AND closing IS NULL AS is_current,
                created_at, coalesce(closing, updated_at) AS updated_at, source_system
            FROM marked
        ),
        inserted AS (
            {new_key} WHERE NOT EXISTS (SELECT 1 FROM after_close d WHERE d.{key} = s.{key})
            UNION ALL
            SELECT {attributes}, updated_at AS effective_from, {tail} FROM {profile} s
            WHERE EXISTS (SELECT 1 FROM after_close d WHERE d.{key} = s.{key}
                    AND NOT d.is_current AND d.effective_to = s.updated_at)
                AND NOT EXISTS (SELECT 1 FROM after_close d WHERE d.{key} = s.{key} AND d.is_current)
        )
        SELECT {', '.join(columns)} FROM after_close
        UNION ALL {keyed} inserted"""


def _gold_relations() -> None:
    for name in _DIMENSIONS:
        RELATIONS[f"dim1_{name}"] = _merge_sql(name, None, f"profile1_{name}")
        RELATIONS[f"dim2_{name}"] = _merge_sql(name, f"dim1_{name}", f"profile2_{name}")
        key, tracked = _DIMENSIONS[name][1:3]
        order = ", ".join(f"{c} ASC NULLS FIRST" for c in (*tracked, "created_at"))
        for n in (1, 2):
            RELATIONS[f"latest_profile{n}_{name}"] = f"""
                SELECT * FROM profile{n}_{name} QUALIFY {key} IS NULL
                    OR row_number() OVER (PARTITION BY {key} ORDER BY updated_at DESC NULLS LAST, {order}) = 1"""
        RELATIONS[f"latest1_{name}"] = _merge_sql(name, None, f"latest_profile1_{name}")
        RELATIONS[f"latest2_{name}"] = _merge_sql(name, f"latest1_{name}", f"latest_profile2_{name}")
        RELATIONS[f"dim3_{name}"] = _merge_sql(name, f"dim2_{name}", f"profile2_{name}")
    RELATIONS["calendar"] = """
        SELECT CAST(d AS DATE) AS full_date, CAST(strftime(d, '%Y%m%d') AS INT) AS date_key,
            CAST(day(d) AS INT) AS day
        FROM generate_series(
            (SELECT min(d) FROM (SELECT DATE '2023-01-01' AS d
                UNION ALL SELECT min(registration_date) FROM silver2_customer
                UNION ALL SELECT min(purchase_date) FROM silver2_inventory_item)),
            (SELECT max(d) FROM (SELECT CAST(TIMESTAMP '2024-03-31 00:00:00' AS DATE) AS d
                UNION ALL SELECT max(rental_date) FROM silver2_rental)), INTERVAL '1' DAY) AS g(d)"""
    today = f"CAST({SECOND_LOAD} AS DATE)"
    RELATIONS["customer_days"] = f"""
        SELECT customer_id, customer_no, date_key, full_date FROM silver2_customer
        JOIN calendar ON full_date >= coalesce(registration_date, DATE '2023-01-01') AND full_date <= {today}"""
    RELATIONS["content_months"] = f"""
        SELECT content_id, date_key, full_date AS month_start FROM silver2_content
        JOIN calendar ON day = 1 AND full_date <= date_trunc('month', {today})
            AND full_date >= DATE '2023-01-01' AND full_date >= date_trunc('month', release_date)"""
    RELATIONS["inventory_days"] = f"""
        SELECT inventory_id, barcode, date_key, full_date FROM silver2_inventory_item
        JOIN calendar ON full_date >= coalesce(purchase_date, DATE '2023-01-01') AND full_date <= {today}
        WHERE barcode IS NOT NULL"""
    one = "CAST(count(*) AS BIGINT)"
    for name, table, entity, day, measures in (
        ("stream_day", "streaming_session", "customer_id", "CAST(start_time AS DATE)",
         f"{one} AS stream_session_count, CAST(coalesce(sum(watch_duration), 0) AS BIGINT) AS total_stream_duration_mins"),
        ("rental_day", "rental", "customer_id", "rental_date", f"{one} AS physical_rental_count"),
        ("return_day", "rental", "customer_id", "return_date", f"{one} AS returned_item_count"),
        ("ticket_day", "support_ticket", "customer_id", "CAST(opened_date AS DATE)",
         f"{one} AS support_ticket_count"),
        ("rental_item_day", "rental", "inventory_id", "rental_date", f"{one} AS rental_count"),
        ("return_item_day", "rental", "inventory_id", "return_date", f"{one} AS return_count"),
    ):
        RELATIONS[name] = f"""
            SELECT {entity}, {day} AS activity_date, {measures}
            FROM silver2_{table} WHERE {day} IS NOT NULL GROUP BY 1, 2"""
    RELATIONS["payment_day"] = """
        SELECT customer_id, CAST(payment_date AS DATE) AS activity_date, sum(amount) AS total_amount_spent
        FROM silver2_payment WHERE upper(status) = 'COMPLETED' GROUP BY 1, 2"""
    month = "CAST(date_trunc('month', {}) AS DATE) AS month_start"
    RELATIONS["stream_month"] = f"""
        SELECT content_id, {month.format('start_time')}, {one} AS total_streams
        FROM silver2_streaming_session GROUP BY 1, 2"""
    RELATIONS["rental_month"] = f"""
        SELECT content_id, {month.format('rental_date')}, {one} AS total_rental_count
        FROM silver2_rental JOIN silver2_inventory_item USING (inventory_id) GROUP BY 1, 2"""
    RELATIONS["revenue_month"] = f"""
        SELECT i.content_id, {month.format('p.payment_date')}, sum(p.amount) AS revenue_generated
        FROM silver2_payment p JOIN silver2_rental r ON r.rental_id = p.rental_id
        JOIN silver2_inventory_item i ON i.inventory_id = r.inventory_id
        WHERE p.status = 'COMPLETED' GROUP BY 1, 2"""
    RELATIONS["rating_month"] = f"""
        SELECT content_id, {month.format('review_date')},
            round(CAST(sum(rating) AS DOUBLE) / count(rating), 6) AS average_customer_rating
        FROM silver2_review GROUP BY 1, 2"""
    RELATIONS["wishlist_month"] = f"""
        SELECT content_id, {month.format('added_date')}, {one} AS wishlist_addition_count
        FROM silver2_wishlist GROUP BY 1, 2"""
    RELATIONS["inventory_status"] = """
        SELECT d.*, CASE WHEN EXISTS (
                SELECT 1 FROM silver2_rental r WHERE r.inventory_id = d.inventory_id
                AND r.rental_date <= d.full_date AND (r.return_date IS NULL OR r.return_date > d.full_date)
            ) THEN 1 ELSE 0 END AS is_utilised
        FROM inventory_days d"""
    as_of = (
        "{0} + INTERVAL '1' {1} - INTERVAL '1' MICROSECOND >= v.effective_from"
        " AND (v.effective_to IS NULL OR {0} + INTERVAL '1' {1} - INTERVAL '1' MICROSECOND < v.effective_to)"
    )
    RELATIONS["customer_versions"] = f"""
        SELECT s.*, v.customer_sk FROM customer_days s JOIN dim2_customer v
        ON v.customer_no = s.customer_no AND {as_of.format('s.full_date', 'DAY')}"""
    RELATIONS["fact_customer"] = """
        SELECT customer_sk, date_key,
            coalesce(stream_session_count, 0) AS stream_session_count,
            coalesce(total_stream_duration_mins, 0) AS total_stream_duration_mins,
            coalesce(physical_rental_count, 0) AS physical_rental_count,
            coalesce(returned_item_count, 0) AS returned_item_count,
            coalesce(total_amount_spent, 0) AS total_amount_spent,
            coalesce(support_ticket_count, 0) AS support_ticket_count
        FROM customer_versions s
        LEFT JOIN stream_day a ON a.customer_id = s.customer_id AND a.activity_date = s.full_date
        LEFT JOIN rental_day b ON b.customer_id = s.customer_id AND b.activity_date = s.full_date
        LEFT JOIN return_day c ON c.customer_id = s.customer_id AND c.activity_date = s.full_date
        LEFT JOIN payment_day d ON d.customer_id = s.customer_id AND d.activity_date = s.full_date
        LEFT JOIN ticket_day e ON e.customer_id = s.customer_id AND e.activity_date = s.full_date"""
    RELATIONS["fact_content"] = f"""
        SELECT content_sk, date_key,
            coalesce(total_streams, 0) AS total_streams,
            coalesce(total_rental_count, 0) AS total_rental_count,
            coalesce(revenue_generated, 0) AS revenue_generated,
            coalesce(average_customer_rating, 0) AS average_customer_rating,
            coalesce(wishlist_addition_count, 0) AS wishlist_addition_count
        FROM content_months s JOIN dim2_content v
            ON v.content_id = s.content_id AND {as_of.format('s.month_start', 'MONTH')}
        LEFT JOIN stream_month a ON a.content_id = s.content_id AND a.month_start = s.month_start
        LEFT JOIN rental_month b ON b.content_id = s.content_id AND b.month_start = s.month_start
        LEFT JOIN revenue_month c ON c.content_id = s.content_id AND c.month_start = s.month_start
        LEFT JOIN rating_month d ON d.content_id = s.content_id AND d.month_start = s.month_start
        LEFT JOIN wishlist_month e ON e.content_id = s.content_id AND e.month_start = s.month_start"""
    RELATIONS["fact_inventory"] = f"""
        SELECT inventory_sk, date_key, coalesce(rental_count, 0) AS rental_count,
            coalesce(return_count, 0) AS return_count,
            CAST(1 - is_utilised AS INT) AS days_available,
            CAST(100 * is_utilised AS DECIMAL(5,2)) AS utilisation_percentage
        FROM inventory_status s JOIN dim2_inventory_item v
            ON v.barcode = s.barcode AND {as_of.format('s.full_date', 'DAY')}
        LEFT JOIN rental_item_day a ON a.inventory_id = s.inventory_id AND a.activity_date = s.full_date
        LEFT JOIN return_item_day b ON b.inventory_id = s.inventory_id AND b.activity_date = s.full_date"""


_source_relations()
_silver_relations()
_profile_relations()
_gold_relations()


def _needed(sql: str, found: dict[str, str]) -> None:
    """Collect the relations ``sql`` mentions, each after those it builds on."""
    for word in re.findall(r"[a-z0-9_]+", sql):
        if word in RELATIONS and word not in found:
            _needed(RELATIONS[word], found)
            found[word] = RELATIONS[word]


def with_relations(sql: str) -> str:
    found: dict[str, str] = {}
    _needed(sql, found)
    heads = ",\n".join(f"{name} AS ({text})" for name, text in found.items())
    return f"WITH {heads}\n{sql}" if heads else sql


def _column(c: str) -> str:
    if c in DATES or c in TIMESTAMPS:
        return f"CAST({c} AS VARCHAR) AS {c}"
    if c in DECIMALS:
        return f"CAST({c} AS DOUBLE) AS {c}"
    return c


def rows_of(relation: str, columns: tuple[str, ...]) -> str:
    return with_relations(f"SELECT {', '.join(map(_column, columns))} FROM {relation}")


def _counts(source: str, processed: str) -> str:
    return (
        f"CAST({source} AS BIGINT) AS source_record_count,"
        f" CAST({processed} AS BIGINT) AS processed_record_count"
    )


_COUNTS = (
    "source_record_count",
    "processed_record_count",
    "inserted_record_count",
    "updated_record_count",
    "rejected_record_count",
)


def _audit_id() -> str:
    parts = ", ".join(map(_key_part, ("batch_id", "dag_id", "run_id")))
    half = f"CAST(('0x' || substr(md5(concat_ws('|', {parts})), 1, 16)) AS UBIGINT)"
    wide = f"CAST({half} AS HUGEINT)"
    return (
        f"CAST(CASE WHEN {wide} >= 9223372036854775808"
        f" THEN {wide} - 18446744073709551616 ELSE {wide} END AS BIGINT) AS audit_id"
    )


def _audit_sql() -> dict[str, str]:
    nothing = " AND ".join(f"{c} IS NULL" for c in ("loaded_rows", *_COUNTS))
    totals = f"""
        SELECT batch_id, dag_id, run_id,
            CASE WHEN bool_or({nothing}) THEN 'Failed' ELSE 'Success' END AS status,
            {', '.join(f"CAST(sum(coalesce({c}, loaded_rows, 0)) AS BIGINT) AS {c}" for c in _COUNTS[:3])},
            {', '.join(f"CAST(sum(coalesce({c}, 0)) AS BIGINT) AS {c}" for c in _COUNTS[3:])}
        FROM source2_audit_task GROUP BY 1, 2, 3"""
    start = "CAST(start_time AS VARCHAR) AS start_time"
    closed = f"""
        SELECT {_audit_id()}, batch_id, dag_id, run_id, {start},
            CASE WHEN t.status IS NULL THEN NULL ELSE '2024-03-31 00:00:00' END AS end_time,
            coalesce(t.status, 'Running') AS status, {', '.join(_COUNTS)}
        FROM source2_audit_run LEFT JOIN ({totals}) AS t USING (batch_id, dag_id, run_id)"""
    metrics = []
    for table in SOURCE_TABLES:
        metrics.append(
            f"SELECT '{table}' AS table_name,"
            f" (SELECT count(*) FROM bronze2_{table}) AS s, (SELECT count(*) FROM silver2_{table}) AS p"
        )
    silver = " UNION ALL ".join(metrics)
    dims = " UNION ALL ".join(
        f"SELECT 'dim_{d}' AS table_name, (SELECT count(*) FROM profile2_{d}) AS p" for d in _DIMENSIONS
    )
    facts = " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, (SELECT count(*) FROM {spine}) AS s, (SELECT count(*) FROM {fact}) AS p"
        for name, spine, fact in (
            ("fact_customer_daily_activity", "customer_days", "fact_customer"),
            ("fact_content_monthly_performance", "content_months", "fact_content"),
            ("fact_inventory_daily_utilization", "inventory_days", "fact_inventory"),
        )
    )
    refresh = (
        f"SELECT table_name, {_counts('s', 'p')}, CAST(p AS BIGINT) AS inserted_record_count,"
        " CAST(0 AS BIGINT) AS updated_record_count,"
        " CAST(greatest(s - p, 0) AS BIGINT) AS rejected_record_count FROM ({}) AS m"
    )
    zero = ", ".join(f"CAST(0 AS BIGINT) AS {c}" for c in _COUNTS[2:])
    return {
        "audit_start": f"""
            SELECT {_audit_id()}, batch_id, dag_id, run_id, {start}, CAST(NULL AS VARCHAR) AS end_time,
                'Running' AS status, {', '.join(f'CAST(NULL AS BIGINT) AS {c}' for c in _COUNTS)}
            FROM source2_audit_run""",
        "audit_rollup": totals,
        "audit_finish": closed,
        "audit_latest_runs": f"""
            SELECT * FROM (
                SELECT *, CAST(row_number() OVER (PARTITION BY dag_id
                    ORDER BY start_time DESC, batch_id DESC, run_id DESC) AS INT) AS run_rank
                FROM ({closed}) AS c
            ) AS ranked WHERE run_rank <= 5""",
        "audit_silver_metrics": refresh.format(silver),
        "audit_dim_metrics": f"SELECT table_name, {_counts('p', 'p')}, {zero} FROM ({dims}) AS m",
        "audit_fact_expected": refresh.format(facts),
    }


def _check_sql() -> dict[str, str]:
    stamp = "CAST({0} AS VARCHAR) AS {0}"
    versions = " UNION ALL ".join(
        f"SELECT 'dim_{d}' AS dimension, CAST({key} AS VARCHAR) AS business_key,"
        " CAST(count(*) AS BIGINT) AS version_count,"
        " CAST(count(*) FILTER (is_current) AS BIGINT) AS current_count,"
        f" count(*) FILTER (is_current) <= 1 AS is_valid FROM dim2_{d} GROUP BY {key}"
        for d, (_, key, _, _) in _DIMENSIONS.items()
    )
    intervals = []
    for d, (_, key, _, _) in _DIMENSIONS.items():
        intervals.append(f"""
            SELECT 'dim_{d}' AS dimension, CAST({key} AS VARCHAR) AS business_key,
                {stamp.format('effective_from')}, {stamp.format('effective_to')}, version_count,
                {stamp.format('ended_by')}
            FROM (
                SELECT {key}, effective_from, effective_to, CAST(count(*) AS BIGINT) AS version_count,
                    max(coalesce(effective_to, TIMESTAMP '9999-12-31 23:59:59.999999')) OVER (
                        PARTITION BY {key} ORDER BY effective_from, effective_to
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ended_by
                FROM dim2_{d} GROUP BY {key}, effective_from, effective_to
            ) AS x WHERE version_count > 1 OR effective_from < ended_by""")
    tables = [(layer, t) for layer in ("bronze2", "silver2") for t in SOURCE_TABLES]
    tables += [("profile2", d) for d in _DIMENSIONS] + [("dim2", d) for d in _DIMENSIONS]
    tables += [("fact", t) for t in ("customer", "content", "inventory")]
    counts = " UNION ALL ".join(
        f"SELECT '{layer.rstrip('2')}' AS layer, '{t}' AS table_name, CAST(count(*) AS BIGINT) AS row_count"
        f" FROM {layer}_{t}"
        for layer, t in tables
    )
    grain, rerun = [], []
    for d, fact in (("customer", "daily_activity"), ("content", "monthly_performance"), ("inventory_item", "daily_utilization")):
        surrogate, key, _, _ = _DIMENSIONS[d]
        short = d.split("_")[0]
        grain.append(f"""
            SELECT 'fact_{short}_{fact}' AS fact, {surrogate} AS version_key, date_key,
                CAST(count(*) AS BIGINT) AS row_count
            FROM fact_{short} GROUP BY {surrogate}, date_key HAVING count(*) > 1""")
        plain = ", ".join(dimension_columns(d))
        rerun.append(f"""
            SELECT 'dim_{d}' AS dimension, {surrogate} AS version_key, CAST({key} AS VARCHAR) AS business_key,
                CAST(effective_from AS VARCHAR) AS effective_from, CAST(effective_to AS VARCHAR) AS effective_to,
                is_current, CAST(sum(side) AS BIGINT) AS surplus FROM (
                SELECT {plain}, -1 AS side FROM dim2_{d}
                UNION ALL SELECT {plain}, 1 AS side FROM dim3_{d}
            ) AS sides GROUP BY {plain} HAVING sum(side) <> 0""")
    return {
        "check_fact_grain": " UNION ALL ".join(grain),
        "check_scd2_versions": versions,
        "check_scd2_intervals": " UNION ALL ".join(intervals),
        "check_row_counts": counts,
        "check_rerun_equal": " UNION ALL ".join(rerun),
    }


def _change_sql() -> str:
    parts = []
    for d, (_, key, tracked, _) in _DIMENSIONS.items():
        differs = " OR ".join(f"t.{c} IS DISTINCT FROM s.{c}" for c in tracked)
        current = f"FROM dim1_{d} t WHERE t.{key} = s.{key} AND t.is_current"
        parts.append(f"""
            SELECT 'dim_{d}' AS dimension, CAST({key} AS VARCHAR) AS business_key,
                CASE WHEN bool_and(is_new) THEN 'new' WHEN bool_or(is_changed) THEN 'changed'
                    WHEN bool_or(is_stale) THEN 'stale' ELSE 'unchanged' END AS change
            FROM (
                SELECT s.{key},
                    NOT EXISTS (SELECT 1 FROM dim1_{d} t WHERE t.{key} = s.{key}) AS is_new,
                    EXISTS (SELECT 1 {current} AND s.updated_at > t.effective_from AND ({differs})) AS is_changed,
                    EXISTS (SELECT 1 {current} AND ({differs})) AS is_stale
                FROM profile2_{d} s
            ) AS x GROUP BY {key}""")
    return " UNION ALL ".join(parts)


def _key(table: str) -> tuple[str, ...]:
    return ("content_id", "genre_id") if table == "content_genre" else COLUMNS[table][:1]


def _missed_sql() -> str:
    """Rows with remainder 3 are missing from the full load; the delta begins after the newest change of the others."""
    changed, parts = "greatest(created_at, updated_at)", []
    for t in SOURCE_TABLES:
        key = _key(t)
        keys, has_key = ", ".join(key), " AND ".join(f"{k} IS NOT NULL" for k in key)
        early = f"(SELECT * FROM source1_{t} WHERE coalesce({key[0]} % 11, 0) <> 3)"
        start = f"(SELECT greatest(max(created_at), max(updated_at)) FROM {early} AS e)"
        times = f"SELECT {keys}, {changed} AS changed FROM"
        delta = f"{times} source2_{t} WHERE {changed} > {start} AND {changed} <= {SECOND_LOAD}"
        parts.append(f"""
            SELECT '{t}' AS table_name, concat_ws(',', {", ".join(f"CAST(s.{k} AS VARCHAR)" for k in key)}) AS row_key,
                CAST(s.changed AS VARCHAR) AS source_changed, CAST(b.changed AS VARCHAR) AS bronze_changed
            FROM (SELECT {keys}, max({changed}) AS changed FROM source2_{t}
                WHERE {has_key} AND ({changed} IS NULL OR {changed} <= {SECOND_LOAD}) GROUP BY {keys}) AS s
            LEFT JOIN (SELECT {keys}, max(changed) AS changed, TRUE AS held
                FROM ({times} {early} AS e UNION ALL {delta}) AS both_loads GROUP BY {keys}) AS b USING ({keys})
            WHERE b.held IS NULL OR s.changed > b.changed OR s.changed IS NOT NULL AND b.changed IS NULL""")
    return " UNION ALL ".join(parts)


_FRACTIONS = DECIMALS | {"average_customer_rating"}


def _digest_sql(tables: dict[str, tuple[str, tuple[str, ...], tuple[str, ...]]]) -> str:
    """Table name, key and digest of the rows of relations; fractions are left out."""
    parts = []
    for name, (relation, columns, key) in tables.items():
        text = ", ".join(f"'{c}=' || coalesce(CAST({c} AS VARCHAR), 'NULL')" for c in sorted(set(columns) - _FRACTIONS))
        keys = ", ".join(f"coalesce(CAST({k} AS VARCHAR), 'NULL')" for k in key)
        parts.append(
            f"SELECT '{name}' AS table_name, concat_ws(',', {keys}) AS row_key,"
            f" md5(concat_ws('|', {text})) AS row_digest FROM {relation}"
        )
    return " UNION ALL ".join(parts)


def oracle_queries() -> dict[str, str]:
    queries: dict[str, str] = {}
    for table in SOURCE_TABLES:
        columns = (*COLUMNS[table], *LINEAGE)
        queries[f"bronze_full_{table}"] = rows_of(f"bronze1_{table}", columns)
        queries[f"bronze_delta_{table}"] = rows_of(f"delta_{table}", columns)
        queries[f"silver_{table}"] = rows_of(f"silver2_{table}", columns)
    queries["bronze_watermark"] = with_relations(
        " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, {_column('last_watermark')} FROM watermark_{t}"
            for t in SOURCE_TABLES
        )
    )
    stored = {t: (f"bronze2_{t}", (*COLUMNS[t], *LINEAGE), _key(t)) for t in SOURCE_TABLES}
    queries["bronze_append"] = with_relations(_digest_sql(stored))
    queries["bronze_append_rerun"] = queries["bronze_append"]
    stored = {t: (f"silver2_{t}", columns, key) for t, (_, columns, key) in stored.items()}
    queries["replace_unless_empty"] = with_relations(_digest_sql(stored))
    queries["silver_changes"] = queries["replace_unless_empty"]
    queries["dim_loads"] = with_relations(
        " UNION ALL ".join(
            f"SELECT 'dim_{d}' AS dimension, {surrogate} AS version_key, CAST({key} AS VARCHAR) AS business_key,"
            " CAST(effective_from AS VARCHAR) AS effective_from, CAST(effective_to AS VARCHAR) AS effective_to,"
            f" is_current FROM dim2_{d}"
            for d, (surrogate, key, _, _) in _DIMENSIONS.items()
        )
    )
    for name, columns in PROFILE_COLUMNS.items():
        queries[f"profile_{name}"] = rows_of(f"profile2_{name}", (*columns, *LINEAGE))
    for name in _DIMENSIONS:
        queries[f"dim_{name}"] = rows_of(f"dim1_{name}", dimension_columns(name))
        queries[f"dim_{name}_second_load"] = rows_of(f"dim2_{name}", dimension_columns(name))
        queries[f"dim_{name}_latest"] = rows_of(f"latest2_{name}", dimension_columns(name))
    queries["reject_reasons"] = with_relations(_reject_sql())
    queries["reject_counts"] = with_relations(
        "SELECT table_name, reason, CAST(count(*) AS BIGINT) AS counted, CAST(count(*) AS BIGINT) AS stored"
        f" FROM ({_reject_sql()}) AS r GROUP BY table_name, reason"
    )
    queries["as_of_payment_version"] = with_relations("""
        SELECT payment_id, customer_no, CAST(payment_date AS VARCHAR) AS payment_date, customer_sk FROM (
            SELECT payment_id, c.customer_no, payment_date, d.customer_sk, d.effective_to
            FROM silver2_payment AS p JOIN silver2_customer AS c USING (customer_id)
                JOIN dim2_customer AS d ON d.customer_no = c.customer_no AND d.effective_from <= p.payment_date
            QUALIFY row_number() OVER (PARTITION BY payment_id ORDER BY d.effective_from DESC, d.customer_sk DESC) = 1
        ) AS newest WHERE effective_to IS NULL OR payment_date < effective_to""")
    queries["scd2_changes"] = with_relations(_change_sql())
    queries["dim_date"] = with_relations(
        "SELECT date_key, CAST(full_date AS VARCHAR) AS full_date, day FROM calendar"
        " WHERE full_date BETWEEN (SELECT min(rental_date) FROM silver2_rental)"
        " AND (SELECT max(rental_date) FROM silver2_rental)"
    )
    plain = {
        "spine_customer_day": ("customer_days", "customer_id customer_no full_date"),
        "spine_content_month": ("content_months", "content_id month_start"),
        "spine_inventory_day": ("inventory_days", "inventory_id barcode full_date"),
        "scd2_as_of_join": ("customer_versions", "customer_id customer_no customer_sk full_date"),
        "agg_stream_day": (
            "stream_day",
            "customer_id activity_date stream_session_count total_stream_duration_mins",
        ),
        "agg_rental_day": ("rental_day", "customer_id activity_date physical_rental_count"),
        "agg_return_day": ("return_day", "customer_id activity_date returned_item_count"),
        "agg_payment_day": ("payment_day", "customer_id activity_date total_amount_spent"),
        "agg_ticket_day": ("ticket_day", "customer_id activity_date support_ticket_count"),
        "agg_stream_month": ("stream_month", "content_id month_start total_streams"),
        "agg_rental_month": ("rental_month", "content_id month_start total_rental_count"),
        "agg_revenue_month": ("revenue_month", "content_id month_start revenue_generated"),
        "agg_rating_month": ("rating_month", "content_id month_start average_customer_rating"),
        "agg_wishlist_month": ("wishlist_month", "content_id month_start wishlist_addition_count"),
        "agg_rental_item_day": ("rental_item_day", "inventory_id activity_date rental_count"),
        "agg_return_item_day": ("return_item_day", "inventory_id activity_date return_count"),
        "inventory_status_day": ("inventory_status", "inventory_id barcode full_date is_utilised"),
        "fact_customer_daily_activity": (
            "fact_customer",
            "customer_sk date_key stream_session_count total_stream_duration_mins"
            " physical_rental_count returned_item_count total_amount_spent support_ticket_count",
        ),
        "fact_content_monthly_performance": (
            "fact_content",
            "content_sk date_key total_streams total_rental_count revenue_generated"
            " average_customer_rating wishlist_addition_count",
        ),
        "fact_inventory_daily_utilization": (
            "fact_inventory",
            "inventory_sk date_key rental_count return_count days_available utilisation_percentage",
        ),
    }
    for name, (relation, columns) in plain.items():
        queries[name] = rows_of(relation, tuple(columns.split()))
    refreshed = {
        name: (plain[name][0], tuple(plain[name][1].split()), tuple(plain[name][1].split()[:2]))
        for name in plain
        if name.startswith("fact_")
    }
    queries["fact_refresh"] = with_relations(
        f"SELECT *, CAST(0 AS INT) AS rows_after_empty_refresh FROM ({_digest_sql(refreshed)}) AS d"
    )
    queries["fact_months"] = with_relations(_digest_sql(refreshed))
    queries["missed_changes"] = with_relations(_missed_sql())
    same = {t: (f"silver2_{t}", "TRUE") for t in SOURCE_TABLES} | {f: (plain[f][0], "TRUE") for f in plain if f.startswith("fact_")}
    for d in _DIMENSIONS:
        columns = ", ".join(dimension_columns(d))
        less = "SELECT {0} FROM dim{1}_{2} EXCEPT ALL SELECT {0} FROM dim{3}_{2}"
        differ = f"({less.format(columns, 2, d, 3)}) UNION ALL ({less.format(columns, 3, d, 2)})"
        same[f"dim_{d}"] = (f"dim2_{d}", f"NOT EXISTS ({differ})")
    queries["check_rerun_digests"] = with_relations(
        " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, (SELECT count(*) FROM {relation}) AS row_count, {equal} AS is_equal"
            for name, (relation, equal) in same.items()
        )
    )
    for name, sql in {**_audit_sql(), **_check_sql()}.items():
        queries[name] = with_relations(sql)
    return queries
