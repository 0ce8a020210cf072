"""Operations of a training-data pipeline over whole document collections.

Nothing else in the library imports this subpackage; deleting it leaves the rest working.
"""
