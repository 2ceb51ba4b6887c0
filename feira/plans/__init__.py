"""Table-level transforms: bronze to silver, silver to gold, gold to segments."""
