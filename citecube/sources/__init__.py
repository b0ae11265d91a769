"""Sources and sinks: the bibliographic adapter over the driver's tables,
CSV dialects, XML record files and table registration."""
