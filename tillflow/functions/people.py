"""Labels of the user dimension."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillflow import fixed_values as fv


def age_in_years(birthday: Column, as_of: Column) -> Column:
    """Whole years of 365 days between two dates.

    Not the calendar age: leap days make it run ahead by up to a few weeks.
    ``as_of`` is an argument so that a run can be repeated. A birthday that is
    no date gives NULL.
    """
    born = F.try_to_timestamp(birthday, F.lit("yyyy-MM-dd")).cast("date")
    return (F.datediff(as_of, born) / F.lit(fv.DAYS_PER_YEAR)).cast("int")


def age_group(age: Column) -> Column:
    """Age label; 20 itself belongs to the middle group, an unknown age has none."""
    return (
        F.when(age < 20, F.lit(fv.AGE_UP_TO_20))
        .when(age > 30, F.lit(fv.AGE_OVER_30))
        .when(age.isNotNull(), F.lit(fv.AGE_21_TO_30))
    )


def gender_name(gender: Column) -> Column:
    """``M`` is male, everything else (NULL as well) is female."""
    return F.when(gender == "M", F.lit(fv.GENDER_MALE)).otherwise(F.lit(fv.GENDER_FEMALE))
