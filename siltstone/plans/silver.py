"""The sixteen Silver tables as specifications, in load order."""

from __future__ import annotations

from siltstone.functions.text import blank_to_null, lower_text, title_text, upper_code
from siltstone.operators.cleanse import Reference, TableSpec
from siltstone.operators.rules import (
    code_of_length,
    day_passed,
    in_order,
    moment_passed,
    not_negative,
    sane_change_times,
    within,
)

CUSTOMER = Reference("customer_id", "customer")
CONTENT = Reference("content_id", "content")

_SPECS = (
    TableSpec(
        name="country",
        key=("country_id",),
        columns=("country_id", "country_name", "country_code"),
        clean={"country_name": blank_to_null, "country_code": upper_code},
        required=("country_name",),
        rules=(code_of_length("country_code", 2),),
    ),
    TableSpec(
        name="city",
        key=("city_id",),
        columns=("city_id", "country_id", "city_name"),
        clean={"city_name": blank_to_null},
        required=("country_id", "city_name"),
        references=(Reference("country_id", "country"),),
    ),
    TableSpec(
        name="customer",
        key=("customer_id",),
        columns=(
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
        clean={
            "customer_no": blank_to_null,
            "first_name": blank_to_null,
            "last_name": blank_to_null,
            "email": lower_text,
            "phone": blank_to_null,
            "gender": upper_code,
            "status": upper_code,
        },
        required=("customer_no", "first_name", "last_name"),
        rules=(
            day_passed("date_of_birth"),
            day_passed("registration_date"),
            in_order("date_of_birth", "registration_date"),
        ),
    ),
    TableSpec(
        name="customer_address",
        key=("address_id",),
        columns=(
            "address_id",
            "customer_id",
            "city_id",
            "address_line",
            "postal_code",
            "address_type",
        ),
        clean={
            "address_line": blank_to_null,
            "postal_code": blank_to_null,
            "address_type": upper_code,
        },
        required=("customer_id", "address_line"),
        rules=sane_change_times(),
        references=(CUSTOMER, Reference("city_id", "city", optional=True)),
    ),
    TableSpec(
        name="content_type",
        key=("content_type_id",),
        columns=("content_type_id", "content_type"),
        clean={"content_type": blank_to_null},
        required=("content_type",),
        rules=sane_change_times(),
    ),
    TableSpec(
        name="content",
        key=("content_id",),
        columns=(
            "content_id",
            "content_type_id",
            "title",
            "release_date",
            "duration_minutes",
            "language",
            "age_rating",
        ),
        clean={"title": blank_to_null, "language": title_text, "age_rating": upper_code},
        required=("title", "content_type_id", "release_date"),
        rules=(
            day_passed("release_date"),
            not_negative("duration_minutes"),
            *sane_change_times(),
        ),
        references=(Reference("content_type_id", "content_type"),),
    ),
    TableSpec(
        name="genre",
        key=("genre_id",),
        columns=("genre_id", "genre_name"),
        clean={"genre_name": title_text},
        required=("genre_name",),
        rules=sane_change_times(),
    ),
    TableSpec(
        name="content_genre",
        key=("content_id", "genre_id"),
        columns=("content_id", "genre_id"),
        rules=sane_change_times(),
        references=(CONTENT, Reference("genre_id", "genre")),
    ),
    TableSpec(
        name="streaming_session",
        key=("stream_id",),
        columns=(
            "stream_id",
            "customer_id",
            "content_id",
            "device_id",
            "start_time",
            "end_time",
            "watch_duration",
            "completion_percentage",
        ),
        required=("customer_id", "content_id", "start_time"),
        rules=(
            in_order("start_time", "end_time"),
            not_negative("watch_duration"),
            within("completion_percentage", 0, 100),
            *sane_change_times(),
        ),
        references=(CUSTOMER, CONTENT),
    ),
    TableSpec(
        name="review",
        key=("review_id",),
        columns=(
            "review_id",
            "customer_id",
            "content_id",
            "rating",
            "review_text",
            "review_date",
        ),
        clean={"review_text": blank_to_null},
        required=("customer_id", "content_id", "rating", "review_date"),
        rules=(within("rating", 0, 5), moment_passed("review_date"), *sane_change_times()),
        references=(CUSTOMER, CONTENT),
    ),
    TableSpec(
        name="wishlist",
        key=("wishlist_id",),
        columns=("wishlist_id", "customer_id", "content_id", "added_date"),
        required=("customer_id", "content_id", "added_date"),
        rules=(moment_passed("added_date"), *sane_change_times()),
        references=(CUSTOMER, CONTENT),
    ),
    TableSpec(
        name="warehouse",
        key=("warehouse_id",),
        columns=("warehouse_id", "city_id", "warehouse_name"),
        clean={"warehouse_name": title_text},
        rules=sane_change_times(),
        references=(Reference("city_id", "city", optional=True),),
    ),
    TableSpec(
        name="inventory_item",
        key=("inventory_id",),
        columns=(
            "inventory_id",
            "content_id",
            "warehouse_id",
            "barcode",
            "purchase_date",
            "item_condition",
            "status",
        ),
        clean={
            "barcode": blank_to_null,
            "item_condition": upper_code,
            "status": upper_code,
        },
        required=("content_id", "warehouse_id", "barcode", "item_condition", "status"),
        rules=(day_passed("purchase_date"), *sane_change_times()),
        references=(CONTENT, Reference("warehouse_id", "warehouse")),
        unique="barcode",
    ),
    TableSpec(
        name="rental",
        key=("rental_id",),
        columns=(
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
        clean={"status": upper_code},
        required=(
            "customer_id",
            "inventory_id",
            "rental_date",
            "due_date",
            "rental_fee",
            "status",
        ),
        rules=(
            day_passed("rental_date"),
            in_order("rental_date", "due_date"),
            in_order("rental_date", "return_date"),
            not_negative("rental_fee"),
            not_negative("late_fee"),
            *sane_change_times(),
        ),
        references=(CUSTOMER, Reference("inventory_id", "inventory_item")),
    ),
    TableSpec(
        name="payment",
        key=("payment_id",),
        columns=(
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
        clean={"payment_type": upper_code, "status": upper_code},
        required=("customer_id", "amount", "payment_date", "payment_type", "status"),
        rules=(moment_passed("payment_date"), not_negative("amount"), *sane_change_times()),
        references=(CUSTOMER, Reference("rental_id", "rental", optional=True)),
    ),
    TableSpec(
        name="support_ticket",
        key=("ticket_id",),
        columns=(
            "ticket_id",
            "customer_id",
            "category_id",
            "opened_date",
            "closed_date",
            "priority",
            "status",
        ),
        clean={"priority": upper_code, "status": upper_code},
        required=("customer_id", "opened_date", "priority", "status"),
        rules=(
            moment_passed("opened_date"),
            in_order("opened_date", "closed_date"),
            moment_passed("closed_date"),
            *sane_change_times(),
        ),
        references=(CUSTOMER,),
    ),
)

SPECS: dict[str, TableSpec] = {spec.name: spec for spec in _SPECS}
