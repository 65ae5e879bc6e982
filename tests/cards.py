"""Small nested records."""

from __future__ import annotations

from datetime import date

from facetmill.schemas import BRONZE_SCHEMA, FACE_SCHEMA


def face(**values):
    image = values.pop("image", None)
    full = {f.name: values.get(f.name) for f in FACE_SCHEMA.fields}
    full["image_uris"] = None if image is None else {"small": image}
    return full


def card(oracle_id, usd=None, usd_foil=None, faces=None, released_at=None, legacy=None, **values):
    flags = {"reprint": values.pop("reprint", False), "digital": values.pop("digital", False)}
    return {
        **face(**values),
        **flags,
        "oracle_id": oracle_id,
        "prices": {"usd": usd, "usd_foil": usd_foil},
        "card_faces": faces,
        "released_at": released_at or date(2020, 1, 1),
        "legalities": {"legacy": legacy},
    }


CARDS = [
    card("a", "1.49", name="Lamp", image="a.jpg", mana_cost="2 parts", type_line="Light", oracle_text="Hang it\nhigh (a hook helps)"),
    card("b", None, "7.20", name="Stool", mana_cost="1 part", type_line="Seat", oracle_text="", power="40", toughness="30"),
    card("c", "3.5", "8", name="Clock", type_line="Device", oracle_text="+1: Wind.", loyalty="6", power="1"),
    card("d", name="Rug", type_line="Textile", oracle_text="(only a note)", defense="5"),
    card(
        "e",
        "5.80",
        name="Desk // Shelf",
        faces=[
            face(name="Desk", image="e0.jpg", mana_cost="4 parts", type_line="Table", oracle_text="Upper\nboard", loyalty="8"),
            face(name="Shelf", image="e1.jpg", mana_cost="6 parts", type_line="Rack", oracle_text="Lower (x) board", loyalty="3"),
        ],
    ),
]


def bronze(spark, records=None):
    records = CARDS if records is None else records
    names = BRONZE_SCHEMA.fieldNames()
    return spark.createDataFrame([tuple(r[n] for n in names) for r in records], BRONZE_SCHEMA)
