"""DataFrame -> DataFrame jobs. Rejected rows keep their input and carry ``_error``."""
