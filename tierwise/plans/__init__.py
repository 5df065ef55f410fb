"""Plans: the topic cascade (``cascade``), report tables (``reports``), period
reports and comparisons (``periods``) and the job entry points (``monthly``)."""
