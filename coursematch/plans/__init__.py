"""The course-matching steps (J1-J9) composed from operators and functions."""
