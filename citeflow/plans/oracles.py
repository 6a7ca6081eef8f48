"""DuckDB oracle SQL for the registered queries.

Each cleaning stage is written independently in DuckDB SQL (not generated from
the Spark code) and chained as CTEs; ``with_stages(upto, body)`` builds the
``WITH`` prefix up to a stage. Only the ``citations`` fixture text is shared,
because it *is* the input definition.
"""

from __future__ import annotations

from citeflow.sources.fixture import citations_sql

# Stage CTEs, in order. Each reads the previous one.
_STAGES: list[tuple[str, str]] = [
    ("citations", citations_sql("lineitem")),
    ("featured", """
        SELECT *,
          try_cast(string_split(issue_date, '/')[1] AS DOUBLE) AS month,
          try_cast(string_split(issue_date, '/')[3] AS INTEGER) AS year,
          CAST(isodow(try_strptime(issue_date, '%m/%d/%Y')) - 1 AS DOUBLE) AS day,
          substring(violation_time, 5, 1) AS meridiem,
          try_cast(substring(violation_time, 1, 2) AS DOUBLE) AS time_hour
        FROM citations"""),
    ("year_filtered", "SELECT * FROM featured WHERE year > 2012 AND year < 2015"),
    ("meridiem_nulled", "SELECT * REPLACE (nullif(meridiem, '') AS meridiem) FROM year_filtered"),
    ("hour_fixed", """
        SELECT * REPLACE (CASE WHEN time_hour <= 0.0 OR time_hour > 12.0 THEN CAST(1.0 AS DOUBLE)
                               ELSE time_hour END AS time_hour)
        FROM meridiem_nulled"""),
    ("state_filtered", "SELECT * FROM hour_fixed WHERE registration_state <> '99'"),
    ("plate_filtered", "SELECT * FROM state_filtered WHERE plate_type <> '999'"),
    ("target_rewritten", """
        SELECT * REPLACE (
          regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
            violation_county, 'KINGS', 'K', 'g'), 'QUEEN', 'Q', 'g'), 'BRONX', 'BX', 'g'),
            'RC', 'R', 'g'), 'RICH', 'R', 'g'), 'NYC', 'NY', 'g') AS violation_county)
        FROM plate_filtered"""),
    ("target_clean", """
        SELECT * FROM target_rewritten
        WHERE violation_county IS NOT NULL AND violation_county <> '103'"""),
    ("blanks_nulled", """
        SELECT * REPLACE (
          nullif(registration_state, '') AS registration_state, nullif(plate_type, '') AS plate_type,
          nullif(issue_date, '') AS issue_date, nullif(vehicle_body_type, '') AS vehicle_body_type,
          nullif(vehicle_make, '') AS vehicle_make, nullif(issuing_agency, '') AS issuing_agency,
          nullif(issuer_command, '') AS issuer_command, nullif(violation_time, '') AS violation_time,
          nullif(violation_county, '') AS violation_county,
          nullif(violation_in_front_of_or_opposite, '') AS violation_in_front_of_or_opposite,
          nullif(meridiem, '') AS meridiem)
        FROM target_clean"""),
    ("cleaned", """
        SELECT registration_state, plate_type, violation_code, vehicle_body_type, vehicle_make,
               issuing_agency, street_code1, street_code2, street_code3, violation_location,
               issuer_precinct, issuer_command, violation_county, violation_in_front_of_or_opposite,
               month, day, meridiem, time_hour
        FROM blanks_nulled
        WHERE registration_state IS NOT NULL AND plate_type IS NOT NULL AND violation_code IS NOT NULL
          AND vehicle_body_type IS NOT NULL AND vehicle_make IS NOT NULL AND issuing_agency IS NOT NULL
          AND street_code1 IS NOT NULL AND street_code2 IS NOT NULL AND street_code3 IS NOT NULL
          AND violation_location IS NOT NULL AND issuer_precinct IS NOT NULL
          AND issuer_command IS NOT NULL AND violation_county IS NOT NULL
          AND violation_in_front_of_or_opposite IS NOT NULL AND month IS NOT NULL
          AND day IS NOT NULL AND meridiem IS NOT NULL AND time_hour IS NOT NULL"""),
    # cleaned rows that keep the row key (for splits and model inputs)
    ("cleaned_keyed", """
        SELECT summons_number, registration_state, plate_type, violation_code, vehicle_body_type,
               vehicle_make, issuing_agency, street_code1, street_code2, street_code3,
               violation_location, issuer_precinct, issuer_command, violation_county,
               violation_in_front_of_or_opposite, month, day, meridiem, time_hour
        FROM blanks_nulled
        WHERE registration_state IS NOT NULL AND plate_type IS NOT NULL AND violation_code IS NOT NULL
          AND vehicle_body_type IS NOT NULL AND vehicle_make IS NOT NULL AND issuing_agency IS NOT NULL
          AND street_code1 IS NOT NULL AND street_code2 IS NOT NULL AND street_code3 IS NOT NULL
          AND violation_location IS NOT NULL AND issuer_precinct IS NOT NULL
          AND issuer_command IS NOT NULL AND violation_county IS NOT NULL
          AND violation_in_front_of_or_opposite IS NOT NULL AND month IS NOT NULL
          AND day IS NOT NULL AND meridiem IS NOT NULL AND time_hour IS NOT NULL"""),
]
_NAMES = [n for n, _ in _STAGES]


def with_stages(upto: str, body: str) -> str:
    """``WITH <stages up to and including upto> <body>``."""
    idx = _NAMES.index(upto)
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in _STAGES[: idx + 1])
    return f"WITH {ctes}\n{body}"
