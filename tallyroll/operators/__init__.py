"""DataFrame operators that know nothing about schools."""
