"""The reference's models as pure DataFrame -> DataFrame functions."""
