"""Building-footprint and roof-imagery analytics as Spark DataFrame jobs."""
