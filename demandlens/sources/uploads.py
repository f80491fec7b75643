"""Uploaded CSV tables: read, check, replace the stored table."""

from ..fixed_values import POSTING_REQUIRED, STUDENT_REQUIRED
from ..functions.lists import split_cells, split_skills
from ..operators.validate import missing_tables, validate_and_prepare
from ..schemas import POSTINGS, STUDENTS
from ..sinks.snapshots import Snapshots
from ..sinks.tables import replace_tables
from .tables import read_csv, table_exists, typed_columns


def accept_uploads(spark, stored, postings_csv=None, students_csv=None):
    """Check the given files and, if all are fine, replace the stored tables.

    ``stored`` maps ``postings`` and ``students`` to their paths, or is a ``Snapshots`` store
    of tables with these names, whose readers never meet a missing table. Returns the
    list of all errors; with an error nothing is replaced.
    """
    plans = (("postings", postings_csv, POSTING_REQUIRED, "posting_id", "JP", POSTINGS, split_skills),
             ("students", students_csv, STUDENT_REQUIRED, "student_id", "S", STUDENTS,
              lambda v: split_cells(v, trim=True)))
    errors, prepared = [], {}
    for label, path, required, id_col, prefix, schema, lists in plans:
        prepared[label] = None
        if path is None:
            continue
        checked = validate_and_prepare(read_csv(spark, path), required, id_col, prefix)
        if checked.error:
            errors.append(f"{label}: {checked.error}")
        else:
            prepared[label] = typed_columns(checked.prepared, schema, lists)
    versioned = isinstance(stored, Snapshots)
    if not errors:
        errors = missing_tables(prepared, {k: k in stored if versioned else table_exists(spark, stored[k])
                                           for k in prepared})
    accepted = {k: df for k, df in prepared.items() if df is not None}
    if not errors and versioned:
        stored.replace(accepted)
    elif not errors:
        replace_tables(spark, {stored[k]: df for k, df in accepted.items()})
    return errors
