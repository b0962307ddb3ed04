from fieldtally.sources.tables import (
    date_spine,
    land_form,
    read_choice_labels,
    read_dim,
    read_form,
    rename_choices,
    spine_between,
)

__all__ = [
    "date_spine", "land_form", "read_choice_labels", "read_dim", "read_form", "rename_choices", "spine_between",
]
