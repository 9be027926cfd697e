"""Literal test rows."""

from datetime import date

DAY = date(2099, 1, 1)

# Nine source records (committee, image and filing numbers shortened by rule below).
_GIFTS = [
    ("IND", "SMITH, JOHN", "ATLANTA", "GA", "30301", "01012025", "100"),
    ("IND", "JONES, MARY", "BOSTON", "MA", "02101", "01012025", "250"),
    ("IND", "HARRIS, JANET P", "NEW YORK", "NY", "10001", "12132025", "500"),
    ("IND", "HARRIS, JANET P", "NEW YORK", "NY", "10001", "12132025", "500"),
    ("ORG", "ACME PAC", "", "GA", "30301", "01152025", "1000"),
    ("IND", "Smith, John", "ATLANTA", "GA", "30301-1234", "01012025", "100"),
    ("IND", "JOHN SMITH", "ATLANTA", "GA", "303011234", "01012025", "100"),
    ("IND", "O'BRIEN, PATRICK", "BOSTON", "MA", "02101", "01012025", "250"),
    ("IND", "MARY-SUE JONES", "NEW YORK", "NY", "10001-5678", "12132025", "500"),
]


def source_row(number, entity="IND", name="SMITH, JOHN", city="ATLANTA", state="GA", zip_code="30301",
               day="01012025", amount="100"):
    """One source record as 21 strings."""
    return (
        "C00887901", "N", "YE", "P", f"2026{number:04d}", "10", entity, name, city, state, zip_code, "ACME", "CLERK",
        day, amount, "", f"T{number}", "", "", "", f"S{number:04d}",
    )


SOURCE_ROWS = [source_row(i + 1, *gift) for i, gift in enumerate(_GIFTS)]

# 26 identity scenarios: record, name, address, ZIP, expected rule and key.
IDENTITY = [
    ("R001", "smith john", "atlanta ga", "30301", "rule1", "smith john|zip:30301"),
    ("R002", "smith john", "atlanta ga", "30301", "rule1", "smith john|zip:30301"),
    ("R003", "jones mary a", "boston ma", "02101", "rule1", "jones mary a|zip:02101"),
    ("R004", "jones mary a", "boston ma", "02101", "rule1", "jones mary a|zip:02101"),
    ("R005", "obrien patrick", "chicago il", "60601", "rule1", "obrien patrick|zip:60601"),
    ("R006", "obrien patrick", "chicago il", "", "rule2", "obrien patrick|zip:60601"),
    ("R007", "davis carol ms", "seattle wa", "98101", "rule1", "davis carol ms|zip:98101"),
    ("R008", "davis carol", "seattle wa", "", "rule2", "davis carol|addr:seattle wa"),
    ("R009", "johnson robert", "denver co", "80201", "rule1", "johnson robert|zip:80201"),
    ("R010", "williams sarah", "miami fl", "33101", "rule1", "williams sarah|zip:33101"),
    ("R011", "brown michael", "phoenix az", "85001", "rule1", "brown michael|zip:85001"),
    ("R012", "garcia linda", "dallas tx", "75201", "rule1", "garcia linda|zip:75201"),
    ("R013", "smith james", "portland or", "97201", "rule1", "smith james|zip:97201"),
    ("R014", "smith james", "portland or", "97201", "rule1", "smith james|zip:97201"),
    ("R015", "lee jennifer", "austin tx", "78701", "rule1", "lee jennifer|zip:78701"),
    ("R016", "lee jennifer", "austin tx", "78701", "rule1", "lee jennifer|zip:78701"),
    ("R017", "taylor william", "nashville tn", "37201", "rule1", "taylor william|zip:37201"),
    ("R018", "taylor william", "nashville tn", "37201", "rule1", "taylor william|zip:37201"),
    ("R019", "taylor william", "nashville tn", "37202", "rule1", "taylor william|zip:37202"),
    ("R020", "anderson patricia", "san francisco ca", "94101", "rule1", "anderson patricia|zip:94101"),
    ("R021", "harris janet p", "new york ny", "10001", "rule1", "harris janet p|zip:10001"),
    ("R022", "harris janet p", "new york ny", "10001", "rule1", "harris janet p|zip:10001"),
    ("R023", "patel anita", "", "", "no_match", "patel anita|id:R023"),
    ("R024", "chen robert", "cambridge ma", "02138", "rule1", "chen robert|zip:02138"),
    ("R025", "chen robert", "cambridge ma", "02139", "rule1", "chen robert|zip:02139"),
    ("R026", "chen robert", "cambridge ma", "", "rule2", "chen robert|zip:02138"),
]


def staged_rows(spark, rows):
    """Rows of (sub_id, name, address, zip[, load date]) as the identity slice of staging."""
    from giftledger.operators.identity import SLICE

    full = [tuple(r) if len(r) == 5 else (*r, DAY) for r in rows]
    return spark.createDataFrame(full, ", ".join(f"{c} string" for c in SLICE[:4]) + ", _load_date date")


def source_frame(spark, rows):
    from giftledger.schemas import source_schema

    return spark.createDataFrame(rows, source_schema())
