"""Running results over growing folders of rearrangements."""
